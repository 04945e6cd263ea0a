"""Spark-native analytics for panels of cumulative counts (place x day)."""
