"""Operators on DataFrames: audit, keys, upserts, joins, loads and lineage."""
