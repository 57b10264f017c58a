"""Column expressions: text cleaning, dates, validity checks. All native, no UDF."""
