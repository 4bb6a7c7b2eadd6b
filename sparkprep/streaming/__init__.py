"""Applying fitted stages to a stream of files."""
