"""Readers, sinks, dimensions and catalog registration."""
