"""Flight-operations analytics on Spark DataFrames and Structured Streaming."""
