"""Operators for preparing training text: quality, duplicates, contamination, extraction, toxicity, mixing, urls, PII."""
