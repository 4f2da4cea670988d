"""Logical sources: schemas, readers, writers and the adapters over the test tables."""
