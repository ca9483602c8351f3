"""Operators on DataFrames: checks, cleaning, deduplication, merge and history."""
