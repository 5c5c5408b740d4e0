"""Compiled tables: each plan combines operators into one table of the data model."""
