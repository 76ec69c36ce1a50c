"""Reusable DataFrame-to-DataFrame operators: filters, ranking, dedup, profiling, quality checks."""
