"""Spark-native analytics over species-occurrence records."""
