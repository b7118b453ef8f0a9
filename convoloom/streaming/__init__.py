"""Structured Streaming counterparts of the session operators."""
