"""Structured Streaming twins of the batch detectors."""
