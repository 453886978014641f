"""Table definitions: functions from input DataFrames to an output DataFrame."""
