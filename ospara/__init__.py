"""Spark-native operators for sensor, incident, feature and document data."""
