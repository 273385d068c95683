"""Tidemark: market-series and event analytics on Spark DataFrames."""
