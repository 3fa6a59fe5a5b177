"""Operators for training corpora."""
