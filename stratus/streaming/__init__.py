"""Structured Streaming wiring of the batch operators."""
