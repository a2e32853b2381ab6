"""Scans of files, streams, the schema registry and the lake."""
