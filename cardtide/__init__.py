"""Monitoring of card transactions as they arrive, on Spark DataFrames and Structured Streaming."""
