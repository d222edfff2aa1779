"""Spark-native caption and transcript analytics."""

__version__ = "0.1.0"
