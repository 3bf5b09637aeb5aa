"""Structured Streaming: the live poll."""
