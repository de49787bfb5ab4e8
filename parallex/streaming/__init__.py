"""Structured Streaming sink for the metric log."""
