"""Operators of a training-data pipeline and their registered queries.

Nothing else in the package imports this one, so it can be removed as a whole.
"""
