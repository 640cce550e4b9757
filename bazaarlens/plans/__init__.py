"""Registered queries: every operator over the given tables, with its check SQL."""
