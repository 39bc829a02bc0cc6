"""Operators for preparing training data: dedup, filtering, mixing, tokenising and formatting."""
