"""Structured Streaming: group state, deadlines and sinks."""
