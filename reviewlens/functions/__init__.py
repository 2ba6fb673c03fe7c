"""Column expressions: text cleaning, field extraction, numbers, names."""
