"""The incremental loads as Structured Streaming jobs."""
