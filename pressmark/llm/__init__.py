"""Operators for preparing training text: dedup, filters, fingerprints, shards, tokens."""
