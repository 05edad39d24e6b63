"""Spark-native analytics for ad events, product reviews and message streams."""
