"""Structured Streaming jobs and keyed state."""
