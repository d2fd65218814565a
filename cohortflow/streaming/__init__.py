"""Structured Streaming ingest of registration files."""
