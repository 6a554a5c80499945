"""Structured Streaming forms of collection and request health."""
