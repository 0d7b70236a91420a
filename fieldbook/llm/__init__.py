"""Operators for preparing training text: scoring, cleaning, deduplication, tokens and packing."""
