"""Tillmark: price-feed analytics on Spark DataFrames and Structured Streaming."""
