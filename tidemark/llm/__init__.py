"""Operators for building training data out of raw text; nothing else in the library imports this."""
