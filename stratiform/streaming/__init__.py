"""Structured Streaming sources and sinks."""
