"""Operators over DataFrames: time series, slices, stored tables and quality checks."""
