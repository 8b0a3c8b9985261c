"""Readers for landed files, literal domain tables and writers."""
