"""Tabular analytics and model-building jobs for Spark DataFrames."""
