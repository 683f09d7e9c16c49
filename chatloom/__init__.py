"""Spark-native preparation, scoring and analysis of conversational training data."""

__version__ = "0.1.0"
