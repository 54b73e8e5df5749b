"""Structured Streaming forms of the matcher and the frontier."""
