"""Operators for building training corpora from web text."""
