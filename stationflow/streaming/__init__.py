"""The batch steps as Structured Streaming jobs."""
