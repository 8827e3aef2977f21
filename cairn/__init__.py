"""Batch analytics on event records as Spark DataFrames."""
