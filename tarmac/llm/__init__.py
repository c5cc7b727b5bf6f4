"""Operators for preparing text for training: cleaning, filtering, deduplication, scoring, encoding and packing."""
