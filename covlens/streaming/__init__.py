"""Structured Streaming: the periodic ingest cycle as a file-source stream."""
