"""Operators over DataFrames: normalisation, dedup, joins, carrier counts, layout, usage."""
