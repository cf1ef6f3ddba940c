"""Operators on DataFrames: conforming, quality checks, global ranking, snapshot sync."""
