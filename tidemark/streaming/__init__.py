"""The same reports over rows that still arrive."""
