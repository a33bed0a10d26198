"""Spark-native analytics for trade tapes: bars, labels, features and validation."""
