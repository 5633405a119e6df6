"""Incremental text processing."""
