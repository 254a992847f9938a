"""Operators for text corpora: deduplication, search, tokens, extraction, filters and classifiers."""
