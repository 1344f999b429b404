"""Sinks: message topics and stored tables."""
