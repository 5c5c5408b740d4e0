"""Lexical-data ETL on Spark: frequency ranks, dictionaries, readings, nesting and exports."""

__version__ = "0.1.0"
