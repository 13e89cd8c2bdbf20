"""Operators for training-data pipelines: cleaning, deduplication, scoring, mixing, packing."""
