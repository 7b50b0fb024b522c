"""Operators over article, label and prediction tables."""
