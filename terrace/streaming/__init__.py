"""Structured Streaming sources, sinks and lag."""
