"""Retail profit analytics on Spark: order lines in, DataFrames out."""
