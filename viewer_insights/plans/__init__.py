"""Composed plans (search master, viewing master, wide table) and the query registry."""
