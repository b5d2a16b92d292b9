"""Reusable DataFrame operators: they take column names and know no table."""
