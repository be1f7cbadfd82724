"""Operators for training-data pipelines: toxicity, deduplication, sharding, extraction, packing, privacy."""
