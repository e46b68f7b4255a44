"""Column expressions: text folding, dates and amounts."""
