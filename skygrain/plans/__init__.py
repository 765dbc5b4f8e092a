"""Batch jobs over the library's tables."""
