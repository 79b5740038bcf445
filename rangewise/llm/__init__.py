"""Operators for preparing training text, each a Spark job over documents.

Nothing outside this subpackage imports it. ``queries.py`` holds the
registered queries and their DuckDB SQL.
"""
