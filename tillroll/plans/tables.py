"""Base tables over one data folder, cleaned once and read by many queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import cleaning, rfm
from tillroll.schema import LINE_COLUMNS
from tillroll.session import durable, ship_package
from tillroll.sources.lines import sales_view

_known: dict[tuple[str, str], "Tables"] = {}


class Tables:
    """Raw lines of ``sf_dir`` and the stored tables derived from them.

    As in a deployment, reports and recommenders read the cleaned table and
    the customer table, which are written on first use, once per application.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._sources: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        ship_package(spark)
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _known:
            _known[key] = cls(spark, sf_dir)
        return _known[key]

    def _store(self, name: str, make) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = durable(make(), name)
        return self._stored[name]

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._sources[name]

    @property
    def raw(self) -> DataFrame:
        return sales_view(self.source)

    @property
    def _marked(self) -> DataFrame:
        """The history without copies, cleaned, the lines that cleaning drops included.

        Copies have the same order, so they are dropped where the lines of an order lie.
        """

        def make() -> DataFrame:
            before = cleaning.pre_cancellation(sales_view(self.source, keyed=True)).drop("order_key")
            return cleaning.marked_lines(before)

        return self._store("pre_cancellation", make)

    @property
    def cleaned(self) -> DataFrame:
        return cleaning.kept_lines(self._marked)

    @property
    def deduplicated(self) -> DataFrame:
        """What the cleaned lines and the return ratio both start from: the history without copies, with tidy descriptions."""
        return self._marked.select(*LINE_COLUMNS)

    @property
    def purchases(self) -> DataFrame:
        return cleaning.purchases_only(self.cleaned)

    @property
    def before(self) -> DataFrame:
        return self.deduplicated.select("customer_id", "invoice_no", "quantity")

    def capped_rfm(self) -> DataFrame:
        """Uncapped features stored, then capped; computed anew on each call."""
        return rfm.cap_upper(durable(rfm.rfm_with_returns(self.purchases, self.before), "rfm"))

    @property
    def customers(self) -> DataFrame:
        return self._store("customers", self.capped_rfm)
