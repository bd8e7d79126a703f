"""Relational operators over archive tables."""
