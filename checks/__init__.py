"""The operators run over the given tables, and the same results in SQL."""
