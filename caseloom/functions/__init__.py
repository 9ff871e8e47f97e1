"""Column builders: each takes and gives Columns, no Python workers."""
