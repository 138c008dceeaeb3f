"""Whole pipelines, DataFrame to DataFrame: collect, classify, discover, extract, release."""
