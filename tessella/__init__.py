"""Tessella: Spark-native analytics over image tiles, detections and training text."""
