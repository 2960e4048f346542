"""Operators of a training-data pipeline: tokenising, deduplication, scans, filtering and mixing."""
