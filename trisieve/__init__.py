"""Spark-native operators for preparing and evaluating retrieval training data."""
