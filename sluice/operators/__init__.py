"""Operators over DataFrames: duplicates, lineage, profiles, joins, run summaries."""
