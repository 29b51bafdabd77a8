"""Column expressions: parsing, rules and geometry."""
