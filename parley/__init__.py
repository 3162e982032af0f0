"""Spark-native analytics over two-channel conversation tables."""
