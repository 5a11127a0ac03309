"""Spark-native engine for teacher-labelled corpora."""
