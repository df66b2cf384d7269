"""Operators for building training data from web text."""
