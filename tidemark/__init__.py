"""tidemark: a Spark-native engine for event feeds that account for every loss."""

__version__ = "0.1.0"
