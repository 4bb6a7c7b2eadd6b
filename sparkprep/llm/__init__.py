"""Operators for preparing text for language-model training, their queries and SQL."""
