"""Spark-native clickstream analytics: sources, operators, marts, streaming and serving."""
