"""Operators on whole DataFrames: rules, keyed picks, exact sums, nearest vectors, scoring."""
