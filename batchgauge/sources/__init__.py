"""Readers for dated batches."""
