"""Operators for training-data pipelines: dedup, filters, mixing, tokens, shards, chat."""
