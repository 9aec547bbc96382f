"""Readers, record schemas and the stand-in records made from the test tables."""
