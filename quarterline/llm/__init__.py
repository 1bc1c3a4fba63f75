"""Operators of a training-data pipeline: deduplication, filtering, scoring, search, mixing and packing."""
