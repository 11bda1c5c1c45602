"""Operators for large-scale training-data pipelines over text documents.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_`` queries over the given tables.  Nothing outside
this package imports it.
"""
