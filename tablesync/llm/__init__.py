"""Operators for training data: counting, extraction, mixing, encoding, search, privacy, quality and duplicates."""
