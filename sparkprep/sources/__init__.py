"""Readers and writers for tables, splits and reports."""
