"""Spark-native analytics over partitioned, offset-addressed record logs."""
