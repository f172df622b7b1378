"""Near-real-time views on Structured Streaming."""
