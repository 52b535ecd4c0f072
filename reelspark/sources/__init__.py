"""Readers, role bindings and sinks."""
