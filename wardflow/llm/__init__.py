"""Operators for training-data corpora and their registered queries; nothing else in the library imports this package."""
