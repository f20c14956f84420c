"""Incremental ingest with Structured Streaming and crawl progress tables."""
