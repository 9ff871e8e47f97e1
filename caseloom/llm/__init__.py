"""Operators for preparing language-model training data.

One module per operator; ``queries`` holds the thin registered queries.  Nothing
outside this subpackage (and ``corpus_pipeline``) imports it.
"""
