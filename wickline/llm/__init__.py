"""Operators of a training-data pipeline: extraction, filters, dedup, formatting and packing."""
