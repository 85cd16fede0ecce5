"""Operators of a training-data pipeline over the ``documents`` tables.

Nothing outside this package imports it. ``queries`` holds the registered
queries, ``oracle`` their DuckDB twins.
"""
