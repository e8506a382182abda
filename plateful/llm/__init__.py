"""Operators for preparing training text: filtering, deduplication, privacy, mixing, packing, search."""
