"""Column -> Column building blocks; every one is a built-in Spark expression."""
