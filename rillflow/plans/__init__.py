"""Composed warehouse jobs."""
