"""Spark-native intake, validation and querying of event tables and streams."""

__version__ = "0.1.0"
