"""Spark-native curation of city, attraction, festival and visitor data."""
