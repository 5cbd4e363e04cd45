"""Readers and writers for the supported text forms."""
