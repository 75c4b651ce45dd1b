"""Reusable DataFrame operators: grouped sums, distinct counts, sentinel joins, filters."""
