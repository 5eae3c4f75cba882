"""Operators for preparing training text: quality, matching, deduplication, encoding and decontamination."""
