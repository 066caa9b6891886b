"""Operators for large training-data pipelines.

Nothing outside this package imports it.  Every operator takes and returns DataFrames;
`queries.py` holds the thin registered queries.
"""
