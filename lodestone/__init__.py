"""Spark-native engine for planning, grounding and auditing synthetic training data."""

__version__ = "0.1.0"
