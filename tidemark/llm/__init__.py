"""Operators of a training-data pipeline: formatting, filtering, deduplication, mixing, sharding."""
