"""Vehicle-telemetry event engine built on Spark DataFrames and Structured Streaming."""
