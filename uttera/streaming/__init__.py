"""Structured Streaming forms of the flows."""
