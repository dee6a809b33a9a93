"""Structured Streaming forms of the lake jobs."""
