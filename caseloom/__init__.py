"""A Spark-native engine for clinical case tables."""
