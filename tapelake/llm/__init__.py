"""Operators for training-data pipelines: deduplication, tokens, decontamination, search, mixing, scans and filters."""
