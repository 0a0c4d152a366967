"""tidemark: a Spark-native engine for event logs, signed closes and their histories."""

__version__ = "0.1.0"
