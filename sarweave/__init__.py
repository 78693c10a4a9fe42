"""sarweave: a Spark-native engine for satellite-radar dataset engineering."""

__version__ = "0.1.0"
