"""Readers and writers for the delimited, JSON-lines and table formats."""
