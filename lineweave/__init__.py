"""Spark-native analytics for short, noisy, mixed-script notes."""
