"""Column functions: texts, dates, names, addresses and hashes."""
