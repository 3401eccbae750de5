"""Lavra operators."""
