"""Structured Streaming: sources, sinks and incremental layer jobs."""
