"""Stored results and model parameters of a batch build.

Everything is a Parquet folder under one directory.  Models are a handful of
numbers, so they are small tables too.  On load each part may be missing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.clv import PurchaseModel, ValueModel
from tillroll.operators.rfm import RFM
from tillroll.operators.segments import SegmentModel, fit_segments
from tillroll.sources.lines import normalize_types

RESULTS = [
    "cleaned_dataset", "rfm_clustered", "rfm_data", "recommendations", "product_list", "association_rules", "bestsellers",
]


@dataclass
class Artifacts:
    """What a build left behind; a part that is missing is ``None``."""

    tables: dict[str, DataFrame | None]
    segments: SegmentModel | None = None
    purchases: PurchaseModel | None = None
    values: ValueModel | None = None


def write_table(df: DataFrame, directory: str, name: str) -> DataFrame:
    """Write one result and read it back."""
    path = f"{directory}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{directory}/{name}")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def save_segment_model(spark: SparkSession, model: SegmentModel, directory: str) -> None:
    scaling = list(zip(RFM, model.means, model.stds))
    write_table(spark.createDataFrame(scaling, "feature string, mean double, std double"), directory, "scaler")
    centres = [(i, *c) for i, c in enumerate(model.centres)]
    schema = "cluster int, " + ", ".join(f"z_{c} double" for c in RFM)
    write_table(spark.createDataFrame(centres, schema), directory, "kmeans")
    names = list(model.segments.items())
    write_table(spark.createDataFrame(names, "cluster int, segment string"), directory, "cluster_mapping")


def load_segment_model(spark: SparkSession, directory: str) -> SegmentModel | None:
    parts = [read_table(spark, directory, n) for n in ("scaler", "kmeans", "cluster_mapping")]
    if any(p is None for p in parts):
        return None
    scaling, centres, names = (p.collect() for p in parts)  # a few rows each
    by_feature = {r["feature"]: r for r in scaling}
    return SegmentModel(
        means=[by_feature[c]["mean"] for c in RFM],
        stds=[by_feature[c]["std"] for c in RFM],
        centres=[[r[f"z_{c}"] for c in RFM] for r in sorted(centres, key=lambda r: r["cluster"])],
        segments={r["cluster"]: r["segment"] for r in names},
    )


def save_lifetime_models(spark: SparkSession, purchases: PurchaseModel, values: ValueModel, directory: str) -> None:
    p, v = purchases, values
    write_table(
        spark.createDataFrame([(p.r, p.alpha, p.a, p.b)], "r double, alpha double, a double, b double"), directory, "bgf"
    )
    write_table(spark.createDataFrame([(v.p, v.q, v.v)], "p double, q double, v double"), directory, "ggf")


def load_artifacts(spark: SparkSession, directory: str) -> Artifacts:
    """All parts found under ``directory``.

    A missing segment model is fitted again when the customer table is there.
    """
    tables = {name: read_table(spark, directory, name) for name in RESULTS}
    for name in ("cleaned_dataset", "rfm_clustered"):
        if tables[name] is not None:
            tables[name] = normalize_types(tables[name])
    bgf, ggf = read_table(spark, directory, "bgf"), read_table(spark, directory, "ggf")
    segments = load_segment_model(spark, directory)
    if segments is None and tables["rfm_clustered"] is not None:
        segments = fit_segments(tables["rfm_clustered"])
    return Artifacts(
        tables=tables,
        segments=segments,
        purchases=None if bgf is None else PurchaseModel(**bgf.first().asDict()),
        values=None if ggf is None else ValueModel(**ggf.first().asDict()),
    )
