"""Reusable data operators: DataFrames in, DataFrames out."""
