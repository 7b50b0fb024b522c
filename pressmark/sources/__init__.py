"""Readers: pages, archives, corpora and image sizes."""
