"""Reproducible samples of an exact size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_exact(df: DataFrame, n: int, key: list[str], seed: int = 42, ties: list[str] = ()) -> DataFrame:
    """``min(n, rows)`` rows chosen by a seeded hash of ``key``.

    The hash makes the choice independent of partitioning and of retries, and
    ``limit`` after ``orderBy`` is a per-partition top-n followed by a merge of
    n rows per partition, not a sort of the table.  ``ties`` settles rows that
    share a key; ``key`` should hold text or whole numbers.
    """
    label = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
    return df.orderBy(F.md5(label.cast("binary")), *key, *ties).limit(n)
