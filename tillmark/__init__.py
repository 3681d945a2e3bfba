"""Governed retail-sales analytics as plain Spark DataFrame plans."""
