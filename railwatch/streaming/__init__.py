"""Structured Streaming pipelines over the operators."""
