"""Reusable DataFrame operators the plans are composed from."""

from tessera.operators.argmax import argmax_key
from tessera.operators.distinct import distinct_counts, key_words
from tessera.operators.hierarchy import forest
from tessera.operators.listagg import ordered_listagg
from tessera.operators.metrics import metric_rows, missing_in, sql_metric_rows
from tessera.operators.surrogate_key import with_row_number

__all__ = ["argmax_key", "distinct_counts", "forest", "key_words", "metric_rows", "missing_in", "ordered_listagg", "sql_metric_rows", "with_row_number"]
