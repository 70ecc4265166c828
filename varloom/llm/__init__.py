"""Operators of a training-data pipeline: cleaning, deduplication, search, sharding, packing and formatting of text."""
