"""Operators on DataFrames: scoring, HTML extraction, dedup, ranking, records."""
