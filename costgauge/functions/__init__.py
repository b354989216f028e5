"""Column expressions: numbers, text, time and prices. No Python UDFs."""
