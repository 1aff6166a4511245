"""Historised warehouse loading and data quality on Spark DataFrames."""
