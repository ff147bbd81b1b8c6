"""Column builders for text."""
