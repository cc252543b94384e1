"""Compact integer keys for text or sparse keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_integer_ids(
    distinct_values: DataFrame, column: str, id_name: str, buckets: int = 1024, first: Column | None = None
) -> DataFrame:
    """Number the rows of a table of distinct values, without a global sort.

    Values are hashed to ``buckets`` and numbered inside their bucket; the
    bucket is the low part of the number.  The numbers are unique, nearly
    dense, and the same whenever a task is run again.  Inside a bucket they
    follow ``first``, then the values.
    """
    bucket = F.pmod(F.xxhash64(column), F.lit(buckets))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy(*([] if first is None else [first]), column))
    return (
        distinct_values.withColumn("bucket", bucket)
        .withColumn(id_name, ((inside - 1) * buckets + F.col("bucket")).cast("bigint"))
        .drop("bucket")
    )
