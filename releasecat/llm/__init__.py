"""Operators for text corpora on the way to training data."""
