"""Structured Streaming ingestion of event logs."""
