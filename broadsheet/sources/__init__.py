"""Readers and writers: site configs, pages, the article store."""
