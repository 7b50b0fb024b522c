"""News-archive analytics as Spark DataFrame jobs."""
