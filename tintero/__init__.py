"""Warehouse building and term analytics for dated text articles, on Spark DataFrames."""

__version__ = "0.1.0"
