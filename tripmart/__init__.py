"""tripmart: a Spark-native toolkit for a trip-data warehouse."""

__version__ = "0.1.0"
