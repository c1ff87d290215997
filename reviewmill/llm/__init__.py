"""Operators for training-data pipelines: deduplication, tokenisation, scoring and mixing."""
