"""Column expressions: text, JSON, vectors and table functions."""
