"""Operators for text corpora and for matching and merging records; nothing else in the library imports them."""
