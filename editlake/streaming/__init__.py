"""Streaming extras."""
