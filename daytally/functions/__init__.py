"""Column expressions, series windows and the exact quantile."""
