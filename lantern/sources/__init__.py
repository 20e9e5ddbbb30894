"""Readers, writers and catalogs."""
