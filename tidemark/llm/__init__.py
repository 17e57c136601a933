"""Operators for preparing training data from document tables."""
