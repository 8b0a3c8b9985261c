"""Capacity and utilisation analytics for care facilities, as PySpark DataFrame functions."""
