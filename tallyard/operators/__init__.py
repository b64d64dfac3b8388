"""Operators: DataFrames in, a DataFrame out; no clock, no collect, no Python functions on rows."""
