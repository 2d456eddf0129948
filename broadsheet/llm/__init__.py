"""Operators for building training data: archives, duplicates, sharding, chat, mixing, quality, packing, extraction."""
