"""Structured Streaming jobs over the message stream."""
