"""Operators for training-data corpora: deduplication, filtering, mixing, sharding, packing."""
