"""Column expressions, all built from Spark SQL functions."""
