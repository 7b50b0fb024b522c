"""Extraction is stateless, so it also runs on a stream of pages."""
