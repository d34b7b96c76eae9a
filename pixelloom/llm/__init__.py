"""Operators for preparing training text: deduplication, filtering, mixing, tokens and archives."""
