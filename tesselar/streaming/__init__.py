"""Structured Streaming forms of the alarm and scaling operators."""
