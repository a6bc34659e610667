"""Spark-native analytics for pooled screens, and for preparing text corpora."""
