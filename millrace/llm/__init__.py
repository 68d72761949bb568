"""Operators of a training-data pipeline: fingerprints, deduplication, tokens, filters, classifiers."""
