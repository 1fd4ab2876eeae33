"""Spark-native analytics over market ticks, news, filings and call transcripts."""

__version__ = "0.1.0"
