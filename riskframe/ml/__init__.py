"""Spark MLlib feature preparation, training suite and metrics."""
