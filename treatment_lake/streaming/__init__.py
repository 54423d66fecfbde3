"""Structured Streaming: file-arrival ingestion and the streaming gold build."""
