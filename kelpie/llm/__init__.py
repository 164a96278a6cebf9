"""Operators of a large-scale training-data pipeline.

One module per operator, each with a general interface; :mod:`kelpie.llm.queries`
holds the thin registered queries.  Nothing outside this package imports it.
"""
