"""Column functions: text, URLs, page extraction."""
