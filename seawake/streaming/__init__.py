"""Structured Streaming: sources, queries and sinks around the shared operators."""
