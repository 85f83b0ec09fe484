"""The ingestion cycle as a Structured Streaming job."""
