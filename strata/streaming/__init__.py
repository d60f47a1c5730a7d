"""Structured Streaming jobs that run to exhaustion and can be replayed."""
