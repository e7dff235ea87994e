"""Structured Streaming front end (an extension)."""
