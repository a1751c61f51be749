"""Column expressions: text, numbers, dates and rates."""
