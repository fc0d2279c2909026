"""Incremental intake of fact extracts."""
