"""Structured Streaming pipelines built from the same column logic as the batch operators."""
