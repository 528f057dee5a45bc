"""Structured Streaming jobs; each shares its transformation with a batch frame."""
