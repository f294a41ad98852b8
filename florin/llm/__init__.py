"""Operators of a training-data pipeline: language, personal data, duplicates, quality, packing."""
