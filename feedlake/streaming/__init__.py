"""Incremental execution with Structured Streaming."""
