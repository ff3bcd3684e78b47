"""Operators for preparing training text: tokens, duplicates, languages, contamination, sharding, output files."""
