"""Column expressions and quantile helpers."""
