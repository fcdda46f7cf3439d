"""Column expressions: text rules, value maps, null handling and rounding."""
