"""Readers, templates and sinks."""
