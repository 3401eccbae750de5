"""Lavra plans."""
