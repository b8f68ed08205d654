"""Inputs derived from the given tables, in Spark and in DuckDB text, for the
registered queries, the tests and the bench; not part of the package."""
