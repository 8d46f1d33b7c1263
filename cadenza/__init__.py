"""Spark-native features over time-indexed media tables."""
