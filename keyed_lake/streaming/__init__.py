"""Structured Streaming jobs, composed of the operators."""
