"""Readers and writers for the entity tables."""
