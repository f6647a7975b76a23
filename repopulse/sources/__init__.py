"""Readers of event feeds, archive files and serving tables."""
