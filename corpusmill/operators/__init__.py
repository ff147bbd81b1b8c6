"""Operators on documents, works and pairs."""
