"""Behavioural cohorts of subscribers on Spark DataFrames."""

__version__ = "0.1.0"
