"""Operators for preparing training data: filters, scans, near-duplicates, tokens and shards."""
