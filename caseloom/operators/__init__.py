"""Operators on DataFrames: harmonise, annotate, match, build, validate, rank, summarise."""
