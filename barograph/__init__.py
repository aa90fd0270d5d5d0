"""Spark-native analytics over multi-channel environmental sensor logs."""
