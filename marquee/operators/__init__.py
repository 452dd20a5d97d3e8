"""Operators from DataFrames to a DataFrame."""
