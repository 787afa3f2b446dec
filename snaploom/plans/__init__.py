"""Composed plans."""
