"""Spark-native analytics for heterogeneous collection records."""

__version__ = "0.1.0"
