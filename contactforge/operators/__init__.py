"""Operators: every function takes DataFrames plus column names and thresholds."""
