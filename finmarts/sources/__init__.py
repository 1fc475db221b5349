"""Readers, writers, schemas and the mapping from the provided test tables."""
