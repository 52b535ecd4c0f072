"""Spark-native analytics for a video subscription service."""
