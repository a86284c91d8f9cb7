"""Operators on DataFrames and tables."""
