"""Registered queries, the nested tables they run on, and equivalent SQL."""
