"""Spark-native analytics over consumer order data."""
