"""Column expressions; nothing in here moves data."""
