"""Invoice lines from doubtful files: readable and rejected ones in one pass, each rejected one with its reason.

``lines.scan_csv`` stays the strict way, where a malformed row fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.text import try_mixed_timestamp
from tillroll.schema import CSV_MISSING, LINE_COLUMNS, RAW_SCHEMA, RAW_TO_NAME

#: The text of a record that doesn't have the fields it should have.
RECORD = "_record"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD, "escape": '"'}
_TEXTS = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_SCHEMA] + [T.StructField(RECORD, T.StringType())])
#: Reasons in the order in which they are looked for.
REASONS = ["malformed", "quantity", "invoice_date", "unit_price", "customer_id"]


def _judged(texts: DataFrame) -> DataFrame:
    """Typed columns, ``reason`` (null for a good line) and ``rejected_text``, what couldn't be read."""
    text = {new: F.when(~F.col(old).isin(CSV_MISSING), F.col(old)) for old, new in RAW_TO_NAME.items()}
    kinds = {new: RAW_SCHEMA[old].dataType for old, new in RAW_TO_NAME.items()}
    typed = {c: text[c] if isinstance(kinds[c], T.StringType) else F.trim(text[c]).try_cast(kinds[c]) for c in LINE_COLUMNS}
    typed["invoice_date"] = try_mixed_timestamp(text["invoice_date"])

    def first(of: dict[str, Column]) -> Column:
        out = F.when(F.col(RECORD).isNotNull(), of["malformed"])
        for c in REASONS[1:]:
            out = out.when(text[c].isNotNull() & typed[c].isNull(), of[c])
        return out

    return texts.select(
        *[typed[c].alias(c) for c in LINE_COLUMNS],
        first({r: F.lit(r) for r in REASONS}).alias("reason"),
        first({**text, "malformed": F.col(RECORD)}).alias("rejected_text"),
    )


def scan_csv_judged(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every record of CSV files (with headers, Latin-1), typed, with ``reason`` and ``rejected_text``.

    Dates become timestamps here, since an unreadable one is a reason.  A file whose header isn't the expected one fails
    the read.
    """
    reader = spark.read.schema(_TEXTS).options(**_OPTIONS).option("header", True).option("encoding", "ISO-8859-1")
    # fewer columns than the file has would hide records of a wrong length
    return _judged(reader.option("enforceSchema", False).option("multiLine", multi_line).option("columnPruning", False).csv(path))


def judge_records(records: DataFrame, column: str) -> DataFrame:
    """The same for a column of CSV records without header, as from a queue or a log."""
    parsed = F.from_csv(F.col(column), _TEXTS.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), _OPTIONS)
    return _judged(records.select(parsed.alias("f")).select("f.*"))


def good_lines(judged: DataFrame) -> DataFrame:
    return judged.filter("reason IS NULL").select(*LINE_COLUMNS)


def rejected_lines(judged: DataFrame) -> DataFrame:
    return judged.filter("reason IS NOT NULL")


def quarantine(judged: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``, both written by one pass over the input.

    They lie in one folder, partitioned by what they are, so each is read without the other.
    """
    marked = judged.withColumn("rejected", F.col("reason").isNotNull())
    marked.write.mode("errorifexists").partitionBy("rejected").parquet(path)
    written = judged.sparkSession.read.schema(marked.schema).parquet(path)
    return good_lines(written.filter("NOT rejected")), written.filter("rejected").drop("rejected")


def reason_counts(judged: DataFrame) -> DataFrame:
    """Lines by reason, ``good`` for those that have none."""
    return judged.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("lines"))
