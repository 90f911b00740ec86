"""Structured Streaming versions of the monitoring counts."""
