"""Batch operators; each takes and returns DataFrames and runs no action unless it writes."""
