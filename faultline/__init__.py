"""Log telemetry analytics on Spark: batch DataFrames and Structured Streaming."""
