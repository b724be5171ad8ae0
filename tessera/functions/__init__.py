"""Column expressions, regex patterns and word lists."""
