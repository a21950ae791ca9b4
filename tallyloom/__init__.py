"""Spark-native analytics for audience measurement reports."""
