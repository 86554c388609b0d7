"""Structured Streaming: validation, windows with late data, duplicates."""
