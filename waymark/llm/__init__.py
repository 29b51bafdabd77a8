"""Training-data operators: ten document, vector and conversation operators.

Nothing outside this subpackage imports it. ``queries`` holds the registered
queries (``QUERIES``) and their DuckDB equivalents (``ORACLE_SQL``).
"""
