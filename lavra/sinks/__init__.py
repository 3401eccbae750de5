"""Sinks: atomic files, lines of JSON with sorted keys, files for each record, manifests, documents, and index tables."""
