"""Spark-native analytics engine for market geography."""

__version__ = "0.1.0"
