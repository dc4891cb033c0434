"""Operators for training-data pipelines: text, tokens, vectors and packing."""
