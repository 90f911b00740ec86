"""Operators of a training-data pipeline: deduplication, tokenising, language, quality and safety filters."""
