"""Invoice-line sources: CSV, Parquet, and a view over the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schema import CSV_MISSING, LINE_COLUMNS, RAW_SCHEMA, RAW_TO_NAME


def scan_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Invoice lines from CSV with a header row, Latin-1 encoded.

    The schema is fixed, so no pass is spent on inference; a malformed row
    fails the read.  ``multi_line`` accepts line breaks inside quotes at the
    price of one task per file.
    """
    raw = (
        spark.read.schema(RAW_SCHEMA)
        .option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    texts = {f.name for f in RAW_SCHEMA if f.dataType.simpleString() == "string"}
    return raw.select(
        *[
            (
                F.when(~F.col(old).isin(CSV_MISSING), F.col(old)) if old in texts else F.col(old)
            ).alias(new)
            for old, new in RAW_TO_NAME.items()
        ]
    )


def write_csv(lines: DataFrame, path: str) -> None:
    """Write invoice lines in the raw CSV layout that ``scan_csv`` reads."""
    named = lines.select(*[F.col(new).alias(old) for old, new in RAW_TO_NAME.items()])
    (
        named.withColumn("InvoiceDate", F.col("InvoiceDate").cast("string"))
        .write.mode("errorifexists")
        .option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def normalize_types(df: DataFrame) -> DataFrame:
    """Settle column types after a Parquet read.

    Whole-number columns are rounded half-to-even and stored as integers;
    dates become timestamps.  Columns that are absent are left out.
    """
    rounded = {"quantity": "int", "recency": "int", "frequency": "int"}
    out = {}
    for name, kind in rounded.items():
        if name in df.columns:
            out[name] = F.bround(F.col(name)).cast(kind)
    if "customer_id" in df.columns:
        out["customer_id"] = F.col("customer_id").cast("bigint")
    if "invoice_date" in df.columns:
        out["invoice_date"] = F.col("invoice_date").cast("timestamp")
    return df.withColumns(out)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with its types settled."""
    return normalize_types(spark.read.parquet(path))


def sales_view(table: Callable[[str], DataFrame], keyed: bool = False) -> DataFrame:
    """Raw invoice lines derived from order tables; ``table`` reads one by name.

    The derivation gives every cleaning branch some work: cancelled and
    returned lines, charge codes, vouchers, missing descriptions and customers,
    free goods, and repeated rows (made by ``explode``, so the fact table is
    scanned once).

    Orders meet their customers before their lines, so lines are exchanged for
    the parts and for the orders only, and lie by order afterwards.  A part's
    texts are joined to its description before they travel with its lines.
    ``keyed`` adds the order's number as ``order_key``: rows grouped by it and
    any other columns are not exchanged again.
    """

    customers = table("customer").join(table("nation"), F.expr("c_nationkey = n_nationkey")).select("c_custkey", "n_name")
    orders = table("orders").join(customers, F.expr("o_custkey = c_custkey"))
    # a flag instead of two texts travels with the line
    lines = table("lineitem").withColumn("cancelled", F.expr("l_returnflag = 'R' AND l_linestatus = 'F'"))
    parts = table("part").selectExpr(
        "p_partkey",
        r"""CASE WHEN p_partkey % 61 = 0 THEN NULL WHEN p_partkey % 67 = 0 THEN concat(p_name, ' damaged??')
            ELSE concat('  ', p_name, ' ', p_brand, ' ', p_type, '\t') END AS description""",
    )
    joined = lines.join(parts, F.expr("l_partkey = p_partkey")).join(orders, F.expr("l_orderkey = o_orderkey"))
    # keys of the table a column comes from, so filters on it reach that table's scan
    return joined.selectExpr(
        "concat(CASE WHEN cancelled THEN 'C' ELSE '' END, CAST(l_orderkey AS STRING)) AS invoice_no",
        """CASE p_partkey % 50 WHEN 0 THEN 'POST' WHEN 1 THEN concat('gift_', CAST(p_partkey AS STRING))
            ELSE CAST(p_partkey AS STRING) END AS stock_code""",
        "description",
        """CAST(CASE WHEN cancelled OR l_orderkey % 97 = 0 THEN -l_quantity ELSE l_quantity END AS INT) AS quantity""",
        """CAST(o_orderdate AS TIMESTAMP) + make_dt_interval(0, CAST(6 + o_orderkey % 14 AS INT), CAST(o_orderkey % 60 AS INT))
            AS invoice_date""",
        "CASE WHEN p_partkey % 101 = 0 THEN 0D ELSE l_extendedprice / l_quantity / 1000 END AS unit_price",
        "CASE WHEN o_orderkey % 20 != 0 THEN CAST(o_custkey AS DOUBLE) END AS customer_id",
        "n_name AS country",
        "explode(array_repeat(1, CASE WHEN o_orderkey % 40 = 10 THEN 2 ELSE 1 END)) AS copy",
        "l_orderkey AS order_key",
    ).select(*LINE_COLUMNS, *(["order_key"] if keyed else []))
