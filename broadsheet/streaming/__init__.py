"""Structured Streaming forms of the log analytics."""
