"""Joins of rows with one figure per key, where a few keys hold many of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of all rows is broadcast; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000


def join_counted(rows: DataFrame, counts: DataFrame, key: str, size: str, total: Column) -> DataFrame:
    """Inner join of ``rows`` with ``counts``: one row per key, the number of its rows in ``size``.

    ``total`` is the number of rows, a scalar.  Frequent keys are joined where their rows lie, by a broadcast of bounded size,
    and only the rows of other keys are exchanged.  ``counts`` should be stored, as it is read three times.
    """
    is_hot = F.col(size) > total * HOT_SHARE
    hot, cold = counts.filter(is_hot), counts.filter(~is_hot)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(others.join(cold, key))
