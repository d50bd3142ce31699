"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` maps
query names to ``(spark, sf_dir) -> DataFrame`` and ``queries.ORACLE`` maps
them to DuckDB SQL where SQL can express the result.
"""
