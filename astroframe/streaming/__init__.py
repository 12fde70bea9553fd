"""Structured Streaming forms of the stateless catalogue operators."""
