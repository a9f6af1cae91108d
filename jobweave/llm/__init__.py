"""Operators for text and training data. Optional: nothing outside imports it."""
