"""Structured Streaming jobs.  Each is a batch function on one micro-batch plus a
thin query around it, so that tests can compare stream and batch results."""
