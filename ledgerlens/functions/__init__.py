"""Column expressions: text, numbers, dates, keys and rule ladders."""
