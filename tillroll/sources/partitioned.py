"""Sinks laid out for later reads: months of cleaned lines that can be rebuilt alone, tables bucketed by customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files of a month at most; more rows than a task should write go to more files.
FILES_PER_MONTH = 8
BUCKETS = 16


def with_month(lines: DataFrame) -> DataFrame:
    """``month`` as text like 1998-07; lines without a date go to the month ``none``."""
    return lines.withColumn("month", F.coalesce(F.date_format("invoice_date", "yyyy-MM"), F.lit("none")))


def write_months(lines: DataFrame, path: str, files: int = FILES_PER_MONTH) -> None:
    """Replaces the months that occur in ``lines`` under ``path``; other months stay as they are.

    A month's rows are dealt to ``files`` tasks by customer, so that a busy month isn't one task and its files are few.
    """
    spread = F.pmod(F.xxhash64("customer_id", "invoice_no"), F.lit(files))
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = with_month(lines).repartition(partitions, "month", spread)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def read_months(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Lines of the months from ``first`` to ``last``; other months aren't listed in the scan."""
    lines = spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))
    if first is not None:
        lines = lines.filter(F.col("month") >= first)
    return lines if last is None else lines.filter(F.col("month") <= last)


def rebuild_months(source: DataFrame, path: str, months: list[str]) -> None:
    """Writes the given months anew from ``source``; a month that has no lines any more keeps no files."""
    spark = source.sparkSession
    chosen = with_month(source).filter(F.col("month").isin(months))
    write_months(chosen.drop("month"), path)
    left = {r["month"] for r in chosen.select("month").distinct().collect()}  # some of ``months``
    for month in set(months) - left:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/month={month}")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def write_bucketed(table: DataFrame, name: str, key: str = "customer_id", buckets: int = BUCKETS) -> DataFrame:
    """A catalog table bucketed and sorted by ``key``; tables of equal buckets join on it without an exchange."""
    # one file a bucket: the rows are dealt as the buckets are
    table.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return table.sparkSession.table(name)
