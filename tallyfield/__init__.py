"""Spark-native toolkit for timestamped incident records, measurement series and area lookups."""
