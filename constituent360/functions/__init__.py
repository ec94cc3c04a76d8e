"""Column expressions: text normalisation, dates, numbers and string similarity."""
