"""Operators for training-data preparation over text tables."""
