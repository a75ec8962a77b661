"""Operators for building training data: dedup, filtering, packing, sharding, scoring, search."""
