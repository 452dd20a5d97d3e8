"""Recommendation analytics on Spark: cleaning, factor models, ranking metrics and profile queries.

Every operator takes DataFrames and returns a DataFrame over all users at once.
"""
