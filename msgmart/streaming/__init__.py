"""The incremental job as a Structured Streaming query."""
