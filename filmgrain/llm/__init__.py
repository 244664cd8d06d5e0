"""Operators for building training data from text, dialogue and vector tables.

Nothing else in the package imports this folder. Every operator takes the columns it
needs by name and ignores all others, so extra columns cannot clash with its own.
"""
