"""Column expressions and small helpers built only from native Spark functions."""
