"""Spark-native analytics over long documents and procurement records."""
