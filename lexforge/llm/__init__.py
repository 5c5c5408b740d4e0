"""Operators for large training-data pipelines: scoring, formatting, packing, joins, archives, fingerprints, search."""
