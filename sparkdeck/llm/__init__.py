"""Operators of a training-data pipeline over ``documents``-like tables.

Each module holds one operator with its own general interface; ``catalog`` holds the
registered ``opN_*`` queries that apply them with production parameters.  Nothing
outside this package imports it.
"""
