"""Batch analytics over scheduled events, on Spark DataFrames."""
