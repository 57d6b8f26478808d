"""Column helpers built only from native Spark expressions."""
