"""Structured Streaming validation, routing and windowed measures."""
