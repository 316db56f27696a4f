"""Spark-native engine for line-level text-recognition corpora."""

__version__ = "0.1.0"
