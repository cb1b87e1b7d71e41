"""Structured Streaming forms of the snapshot operators."""
