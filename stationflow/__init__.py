"""Spark-native analytics for mobile-network station data."""
