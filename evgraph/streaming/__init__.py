"""Structured Streaming forms of the observation operators."""
