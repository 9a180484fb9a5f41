"""Readers of capture indexes and archive records."""
