"""Batch and streaming business reports written with DataFrames, SQL and Structured Streaming."""
