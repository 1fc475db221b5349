"""Operators for large text corpora: scoring, extraction, deduplication, mixing, packing and token files."""
