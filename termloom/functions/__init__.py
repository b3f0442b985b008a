"""Column expressions: tokenizing, counting, weights and text rendering."""
