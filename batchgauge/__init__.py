"""Batch scoring, data-quality, drift and evaluation work as Spark DataFrame operators."""
