"""Operators for preparing training data: deduplication, classifiers, packing, search, extraction and tokenizing."""
