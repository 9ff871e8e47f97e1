"""Readers: delimited tables, ontologies, nested documents, annotation maps."""
