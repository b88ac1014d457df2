"""Readers, load strategies and sinks."""
