"""Spark-native analytics for public spending, bills and roll-call votes."""
