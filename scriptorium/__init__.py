"""Spark-native engine for curating scientific literature as data."""
