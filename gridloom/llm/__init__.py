"""Operators for training-data pipelines: extraction, filters, deduplication, tokens, archives."""
