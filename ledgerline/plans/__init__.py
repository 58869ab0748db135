"""Registered queries: finance inputs derived from the given tables, the query list and its SQL checks."""
