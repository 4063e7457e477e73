"""Operators for preparing training data: tokens, extraction, duplicates, personal data, quality, packing."""
