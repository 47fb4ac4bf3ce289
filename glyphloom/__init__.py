"""Spark-native text-evidence and entity analytics."""
