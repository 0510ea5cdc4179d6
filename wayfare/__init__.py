"""Spark-native analytics over transit networks and data pipelines."""
