"""Ordered incremental runs over newly arrived files."""
