"""Spark-native analytics over collections of bond prospectuses."""
