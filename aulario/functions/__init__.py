"""Column -> Column helpers, all built-in expressions (no Python UDF)."""
