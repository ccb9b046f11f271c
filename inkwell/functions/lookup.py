"""Small fixed tables as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(key: Column, table: dict) -> Column:
    """The value of key in a fixed table, null if it has none; one map literal, folded once."""
    pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.try_element_at(pairs, key)
