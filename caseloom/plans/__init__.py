"""Whole pipelines, as plans over the operators, and the command line."""
