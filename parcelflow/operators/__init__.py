"""Relational steps: DataFrames in, DataFrames out."""
