"""Spark-native analytics for keyed, spatial and tabular evidence data."""
