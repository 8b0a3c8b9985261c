"""Incremental forms of the load."""
