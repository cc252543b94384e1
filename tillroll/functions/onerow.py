"""Using a one-row result on every row of another table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_one_row(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns of ``one_row`` as the struct column ``name``.

    A scalar subquery: it runs once and reaches the tasks as a value, without
    a join.  It is attached once and then referred to by name, since every
    mention of a subquery is planned again.
    """
    return df.withColumn(name, one_row.select(F.struct(*one_row.columns)).scalar())
