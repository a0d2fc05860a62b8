"""Column expressions: every one is a composition of Spark built-ins."""
