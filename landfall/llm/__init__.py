"""Operators of a training-data pipeline, each registered as a query.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered queries and their DuckDB SQL.
"""
