"""Streams of records: deduplication within a watermark, windowed counts, and upserts into a table."""
