"""Structured Streaming variants of the daily jobs."""
