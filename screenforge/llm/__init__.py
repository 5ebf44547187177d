"""Operators for preparing training data: counting, fingerprinting, packing, deduplication, language, extraction."""
