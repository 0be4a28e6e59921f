"""Registered queries: each pairs a library job on the given tables with an equivalent SQL text."""
