"""Readers and writers for landing formats, contracts and run records."""
