"""Readers, writers and the views that map the base tables onto the market schema."""
