"""Readers, writers, schemas and the domain views over the driver tables."""
