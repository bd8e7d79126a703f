"""Readers of the table, feed, capture and page formats."""
