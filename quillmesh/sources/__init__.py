"""Readers, writers and stage storage."""
