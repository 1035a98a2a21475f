"""Readers and writers: raw CSV files, test-data projections, managed tables."""
