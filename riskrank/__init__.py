"""Tabular risk scoring and ranking on Spark DataFrames."""

__version__ = "0.1.0"
