"""Incremental arrival of packages."""
