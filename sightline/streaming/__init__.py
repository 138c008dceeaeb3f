"""Incremental runs: resume by range, cross-run dedup, file streams."""
