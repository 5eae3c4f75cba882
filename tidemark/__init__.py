"""Tidemark: a Spark-native engine for social-text signals, market joins and corpus preparation."""

__version__ = "0.1.0"
