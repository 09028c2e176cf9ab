"""Operators of a large-scale training-data pipeline.

Nothing else in the package imports this folder. Each module holds one
operator with a general interface; ``queries.py`` registers the thin
``opN_<name>`` queries and ``oracle.py`` the DuckDB SQL of those that SQL
can express.
"""
