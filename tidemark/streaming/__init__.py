"""Structured Streaming: sinks, runs and their progress."""
