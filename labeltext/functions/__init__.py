"""Column expressions: text, labels, scores."""
