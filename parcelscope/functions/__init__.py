"""Column builders. Everything here is a composition of Spark built-ins."""
