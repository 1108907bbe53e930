"""Operators for training-data pipelines: deduplication, mixing, search, archives, models, tokens."""
