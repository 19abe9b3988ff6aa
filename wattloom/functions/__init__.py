"""Column expressions. All of them stay inside Spark's own functions."""
