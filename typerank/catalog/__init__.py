"""Registered queries on the given tables, and equivalent SQL."""
