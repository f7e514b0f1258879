"""Column expressions: text, colours."""
