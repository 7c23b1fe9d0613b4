"""Corpus operators for training-data pipelines.

Nothing outside this subpackage imports it; ``queries.py`` holds the registered
queries and ``ORACLE_SQL`` their DuckDB equivalents where SQL can express them.
"""
