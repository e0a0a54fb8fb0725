"""Operators for training-data pipelines: packing, privacy, search, language, deduplication, toxicity, mixing, quality."""
