"""Operators of a training-data pipeline: duplicates, quality, safety, mixing."""
