"""Operators on large text collections: filters, joins, mixing and writing of training data."""
