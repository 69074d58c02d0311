"""Structured Streaming execution of the reprocessing steps."""
