"""Curation engine for conversational training data, built on Spark DataFrames."""

__version__ = "0.1.0"
