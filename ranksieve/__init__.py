"""Spark-native engine for semantic ranking of document collections."""
