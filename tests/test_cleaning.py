import re
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillroll.functions.text import parse_mixed_timestamp
from tillroll.operators import cleaning
from tillroll.sources.lines import normalize_types, sales_view, scan_csv, write_csv

SCHEMA = (
    "invoice_no string, stock_code string, description string, quantity int, invoice_date string, "
    "unit_price double, customer_id double, country string"
)


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def line(invoice="123", code="A", text="TEST", quantity=1, date="2023-01-01", price=10.0, customer=100.0, country="UK"):
    return (invoice, code, text, quantity, date, price, customer, country)


def test_copies_become_one_row(spark):
    cleaned, _, _ = cleaning.clean_lines(lines(spark, line(), line()))
    assert cleaned.count() == 1


def test_cancelled_invoice_is_removed_but_kept_for_returns(spark):
    raw = lines(spark, line(), line(invoice="C124", code="B", quantity=-1, customer=101.0), line(invoice="c1"))
    cleaned, purchases, before = cleaning.clean_lines(raw)
    assert {r.invoice_no for r in cleaned.collect()} == {"123", "c1"}
    assert purchases.count() == 2
    assert before.count() == 3


def test_missing_customer_is_dropped_and_number_becomes_integer(spark):
    raw = lines(spark, line(customer=None), line(customer=float("nan")), line(customer=12345.0))
    kept = cleaning.keep_known_customers(raw)
    assert [r.customer_id for r in kept.collect()] == [12345]
    assert dict(kept.dtypes)["customer_id"] == "bigint"


@pytest.mark.parametrize(
    "text, tidy",
    [(None, "NAN"), ("\t mug \n", "MUG"), (" mug ", "MUG"), (" a  b\x1f", "A  B"), ("", "")],
)
def test_description_is_tidied(spark, text, tidy):
    assert cleaning.clean_description(lines(spark, line(text=text))).first().description == tidy


def test_admin_codes_are_exact_and_case_sensitive(spark):
    raw = lines(spark, *[line(code=c) for c in ("POST", "post", "gift_0001", "Gift_1", None, "POSTER")])
    kept = {r.stock_code for r in cleaning.drop_admin_codes(raw).collect()}
    assert kept == {"post", "Gift_1", None, "POSTER"}


def test_admin_texts_are_literal_and_ignore_case(spark):
    raw = lines(spark, *[line(text=t) for t in ("a?? b", "Checked mug", "mug?", "plain", None, "it's a damaged\\x")])
    kept = {r.description for r in cleaning.drop_admin_texts(raw).collect()}
    assert kept == {"mug?", "plain", None}
    own = cleaning.drop_admin_texts(raw, ["it's", "\\x"]).count()
    assert own == 5


def test_mixed_dates(spark):
    texts = ["12/1/2010 8:26", "2010-12-01 08:26:00", "2010-12-01", None]
    raw = lines(spark, *[line(date=d) for d in texts])
    parsed = [r.invoice_date for r in cleaning.parse_dates(raw).collect()]
    assert parsed == [datetime(2010, 12, 1, 8, 26), datetime(2010, 12, 1, 8, 26), datetime(2010, 12, 1), None]
    bad = raw.limit(1).select(parse_mixed_timestamp(F.lit("bad")).alias("d"))
    with pytest.raises(PySparkException):
        bad.collect()


def test_audit_adds_up(tables):
    rows = {r.stage: r.rows for r in cleaning.clean_audit(tables.raw).collect()}
    assert sum(rows.values()) == tables.raw.count() == 6145
    assert rows["copies"] == 145
    assert rows["purchase"] == tables.purchases.count() == 4482
    assert rows["purchase"] + rows["not_purchase"] == tables.cleaned.count() == 4530
    assert tables.before.count() == 5691


def test_csv_round_trip_and_missing_texts(spark, tmp_path):
    raw = lines(spark, line(text='  say "mug", \t'), line(text="NA", customer=None), line(text="café"))
    write_csv(raw, str(tmp_path / "csv"))
    back = scan_csv(spark, str(tmp_path / "csv"))
    assert {(r.description, r.customer_id) for r in back.collect()} == {
        ('  say "mug", \t', 100.0), (None, None), ("café", 100.0),
    }
    (tmp_path / "bad.csv").write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n1,A,x,many,d,1,2,UK\n"
    )
    with pytest.raises(Exception, match="MALFORMED|bad.csv"):
        scan_csv(spark, str(tmp_path / "bad.csv")).collect()


def test_types_are_rounded_half_to_even(spark):
    df = spark.createDataFrame([(0.5, 1.5, 2.5)], "quantity double, recency double, frequency double")
    assert tuple(normalize_types(df).first()) == (0, 2, 2)


def test_lines_are_exchanged_for_parts_and_orders_only(spark, tables):
    broadcasts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = cleaning.pre_cancellation(sales_view(tables.source, keyed=True)).drop("order_key")
        plan = keyed._jdf.queryExecution().executedPlan().toString()
        rows = keyed.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
    exchanged = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(exchanged) == sorted(
        ["l_partkey", "p_partkey", "l_orderkey", "o_orderkey", "o_custkey", "c_custkey", "c_nationkey", "n_nationkey"]
    )
    assert sorted(map(repr, rows)) == sorted(map(repr, cleaning.pre_cancellation(tables.raw).collect()))


def test_history_is_stored_once_for_cleaned_lines_and_returns(tables):
    assert set(tables.cleaned.inputFiles()) == set(tables.before.inputFiles())
    expected = cleaning.clean_lines(tables.raw)[0]
    assert tables.cleaned.columns == expected.columns
    assert sorted(map(repr, tables.cleaned.collect())) == sorted(map(repr, expected.collect()))


def test_a_parts_texts_travel_with_its_lines_as_one_description(spark, tables):
    broadcasts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sales_view(tables.source)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
    (sent,) = re.findall(r"Exchange hashpartitioning\(l_orderkey#.*\n.*Project \[(.*)\]", plan)
    assert re.findall(r"(?:AS )?(description|p_name|p_brand|p_type)#", sent) == ["description"]


def test_stored_history_holds_no_amounts(spark, tables):
    assert "total_amount" not in spark.read.parquet(*tables.cleaned.inputFiles()).columns
    amounts = tables.cleaned.selectExpr("total_amount", "quantity * unit_price")
    assert amounts.count() > 0 and all(a == b for a, b in amounts.collect())
