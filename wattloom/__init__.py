"""Hourly energy-demand features as plain Spark DataFrame code."""
