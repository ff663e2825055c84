"""Registered queries and the views that bind them to the given tables."""
