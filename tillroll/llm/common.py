"""What the corpus operators share: tables, stored intermediates, joins with hot keys."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import durable, ship_package

#: A key with more than this share of all rows counts as hot, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 1000
#: 64-bit words of a bitmap that is broadcast.
BITMAP_WORDS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, read by Spark wherever the folder lives."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and re-readable after the loss of an executor."""
    return durable(df, name)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of jobs whose DataFrames are gone, which it does when the driver collects garbage.

    For a step that has written its result and exchanged much for it, before the next one does the same.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def maybe_among(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``maybe``: whether their number in ``name`` may be in that column of ``keys``.

    True for all that are and for few others, so the rest needn't be exchanged for an exact join. The keys are hashed into
    a bitmap of bounded size, which is broadcast whatever the tables' sizes; the fuller it is, the more others it marks.
    """
    place = F.xxhash64(name)
    word = F.pmod(F.shiftrightunsigned(place, 6), F.lit(BITMAP_WORDS)).alias("bitmap_word")
    bit = F.expr(f"shiftleft(1L, cast(xxhash64(`{name}`) & 63 as int))")
    bits = keys.groupBy(word).agg(F.bit_or(bit).alias("bitmap_bits"))
    found = F.coalesce(F.col("bitmap_bits").bitwiseAND(bit) != 0, F.lit(False))
    return rows.withColumn("bitmap_word", word).join(F.broadcast(bits), "bitmap_word", "left").select(*rows.columns, found.alias("maybe"))


def narrowed(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows that ``maybe_among`` marks, for an exact join with ``keys``."""
    return maybe_among(rows, keys, name).filter("maybe").drop("maybe")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: str) -> DataFrame:
    """``rows`` with the columns of ``groups``, which has one row per string key and its number of rows in ``size``.

    Groups that hold more than HOT_SHARE of all rows are at most 1 / HOT_SHARE many whatever the input, so they are
    broadcast; their rows then take no part in the shuffle by key: they are dealt by ``spread`` instead. ``groups``
    must be stored, as it is read three times. Keys that it lacks get nulls.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    others = [c for c in groups.columns if c != key]
    is_hot = F.col(size) > F.lit(total * HOT_SHARE)
    hot = groups.filter(is_hot).select(key, *[F.col(c).alias(f"hot_{c}") for c in others])
    cold = groups.filter(~is_hot).withColumnRenamed(key, "cold_key")
    found = F.col(f"hot_{size}").isNotNull()
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn(
        "deal", F.when(found, F.concat(F.lit("hot "), F.coalesce(F.col(spread).cast("string"), F.lit("")))).otherwise(F.col(key))
    )
    joined = dealt.join(cold, dealt["deal"] == cold["cold_key"], "left")
    return joined.select(
        *rows.columns, *[F.when(found, F.col(f"hot_{c}")).otherwise(F.col(c)).alias(c) for c in others]
    )


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place (from 0) in a total order.

    Rows are dealt in ranges and sorted inside them; only the number of rows of each partition meets in one place.
    ``rows`` must be stored, as the ranges are found in a pass of their own.  Rows that the order doesn't tell apart
    get consecutive places.
    """
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inside = F.monotonically_increasing_id()  # the partition in its upper bits, the row's place there in the lower 33
    dealt = stored(rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("inside", inside), "numbered")
    part = F.shiftrightunsigned("inside", 33)
    sizes = sorted(tuple(r) for r in dealt.groupBy(part.alias("part")).count().collect())  # one row a partition
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    start = F.broadcast(spark.createDataFrame(starts, "part long, start long"))
    place = (F.col("start") + F.col("inside").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")
    return dealt.join(start, part == start["part"]).select(*rows.columns, place.alias(name))
