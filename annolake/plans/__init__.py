"""Registered queries and the tables they are derived from."""
