"""Structured Streaming over the batch transforms."""
