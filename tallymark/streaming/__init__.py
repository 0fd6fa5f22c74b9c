"""Incremental runs of the row-local scoring jobs."""
