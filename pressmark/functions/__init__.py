"""Column functions: text, URLs, dates and HTML."""
