"""Composed analyses."""
