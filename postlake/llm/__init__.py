"""Operators for large text corpora used as training data. Nothing outside this package imports it."""
