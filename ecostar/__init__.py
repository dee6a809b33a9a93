"""Environmental data warehouse as PySpark DataFrame and Structured Streaming jobs."""
