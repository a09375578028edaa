"""Operators for training-data corpora: filtering, deduplication, extraction, encoding."""
