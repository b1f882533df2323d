"""Column expressions: names, dates and casts."""
