"""Rendered documents and their writers."""
