"""Spark-native go-to-market funnel analytics."""
