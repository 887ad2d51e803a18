"""Spark-native engine for verified, comparable facts and training-data work."""
