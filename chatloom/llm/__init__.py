"""Operators of a large-scale training-data pipeline.

Each module holds one operator with its own general interface; ``queries`` registers the
``opN_<name>`` queries and their DuckDB SQL. Nothing outside this package imports it, except
``corpus_pipeline.py`` and the guarded import in ``__spark_entry__.py``.

Conventions shared by all operators
* an operator reads only the columns it names; further input columns, also ones whose names clash
  with result columns, are ignored
* a null text, url or html counts as empty unless the operator says otherwise; null ids stay null
* repeated rows are rows of their own and get the same result each
* an empty table gives an empty result of the same schema
"""
