"""Spark-native lakehouse for keyed market time series."""
