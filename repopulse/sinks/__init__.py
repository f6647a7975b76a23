"""Idempotent writers of the serving tables."""
