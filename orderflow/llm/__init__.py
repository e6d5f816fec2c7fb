"""Operators for text corpora: counts, scans, duplicates, packing, shards."""
