"""Spark-native processing of blockchain-shaped event data."""
