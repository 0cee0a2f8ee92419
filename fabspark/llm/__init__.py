"""Operators for preparing training text: rules, deduplication, privacy, mixing, scoring, tokens."""
