"""Column expressions: dates and money."""
