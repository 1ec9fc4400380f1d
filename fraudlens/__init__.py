"""Spark-native detection of suspicious payment transactions, in batch and in streams."""
