"""Column-level building blocks; nothing here runs Python per row."""
