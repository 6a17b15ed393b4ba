"""Structured Streaming forms of the daily increments."""
