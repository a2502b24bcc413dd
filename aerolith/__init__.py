"""Spark-native analytics for aircraft surveillance data."""

__version__ = "0.1.0"
