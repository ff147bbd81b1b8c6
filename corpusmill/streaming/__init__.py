"""Operators over unbounded input."""
