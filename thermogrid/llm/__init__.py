"""Operators for large training corpora: one module per operator.

Nothing else in the package imports this subpackage; the queries that apply
the operators to the tables are in :mod:`thermogrid.llm.queries`.
"""
