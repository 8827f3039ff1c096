"""Structured Streaming use of the batch steps."""
