"""Operators for training-data pipelines: quality, duplicates, packing, extraction, tokens."""
