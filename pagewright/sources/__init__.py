"""Readers, configuration and sinks."""
