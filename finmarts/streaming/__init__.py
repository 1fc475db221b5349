"""Micro-batch runs of the incremental fact upsert."""
