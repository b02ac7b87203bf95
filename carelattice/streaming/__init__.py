"""Structured Streaming form of scoring."""
