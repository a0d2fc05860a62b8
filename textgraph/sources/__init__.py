"""Readers of line, message and adjacency text, and their parsers for lines already in a DataFrame."""
