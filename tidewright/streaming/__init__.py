"""Structured Streaming jobs for files as they land."""
