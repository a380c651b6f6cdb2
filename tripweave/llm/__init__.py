"""Operators of a training-data pipeline: filters, de-duplication, search, mixing, scoring, formatting."""
