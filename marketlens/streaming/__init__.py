"""Streaming forms of the keyed rules and jobs."""
