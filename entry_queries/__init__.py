"""Queries over the given tables, seen as retail drops, and the same results in SQL."""
