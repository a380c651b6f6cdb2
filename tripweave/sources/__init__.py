"""Readers, dimension tables and sinks."""
