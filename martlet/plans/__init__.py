"""Metric registry and the catalogue of queries."""
