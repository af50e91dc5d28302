"""Operators for training-data pipelines: sharding, packing, language, duplicates, archives, extraction, counts."""
