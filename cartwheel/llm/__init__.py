"""Operators of a training-data pipeline over the ``documents`` table.

Nothing else in the library imports this subpackage. Each module holds one operator
(its general functions) and the thin ``opN_<name>`` query that applies it to a whole
table; ``queries.py`` lists the queries and their DuckDB SQL.
"""
