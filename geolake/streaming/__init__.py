"""Keeping the index current."""
