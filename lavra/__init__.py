"""Lavra: a PySpark-native engine for building and querying document corpora."""
