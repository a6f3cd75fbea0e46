"""Operators for large text corpora: quality, near copies, leaks, secrets, tokens.

Nothing outside this subpackage imports it. Every operator is a function of
DataFrames; ``queries.py`` holds the registered queries and ``oracle.py``
their DuckDB SQL where SQL can express them.
"""
