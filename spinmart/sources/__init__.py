"""Readers and the schemas they use."""
