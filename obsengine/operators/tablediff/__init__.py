"""Comparing, merging and patching snapshots of a table."""
