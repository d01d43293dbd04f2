"""Spark-native engine for harmonising vocabularies and data dictionaries."""
