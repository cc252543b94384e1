"""Customer segments: K-Means on scaled log RFM, with rule-based names."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.onerow import with_one_row
from tillroll.functions.sampling import sample_exact
from tillroll.operators.rfm import RFM
from tillroll.schema import SEGMENT_NOTES
from tillroll.session import durable

SCALED = [f"z_{c}" for c in RFM]


@dataclass(frozen=True)
class SegmentModel:
    """Scaling, centres and segment names; small enough to travel as literals."""

    means: list[float]
    stds: list[float]
    centres: list[list[float]]
    segments: dict[int, str]
    inertia: float | None = None


def _log(c: str) -> Column:
    return F.log1p(F.col(c).cast("double"))


def scaling(rfm: DataFrame) -> DataFrame:
    """Mean and population deviation of log1p of the RFM columns, one row."""
    return rfm.agg(
        *[F.avg(_log(c)).alias(f"mean_{c}") for c in RFM],
        *[F.stddev_pop(_log(c)).alias(f"std_{c}") for c in RFM],
    )


def scale_rfm(rfm: DataFrame) -> DataFrame:
    """Standardised log1p columns ``z_*``; a constant column becomes 0."""
    z = {
        f"z_{c}": (_log(c) - F.col(f"s.mean_{c}"))
        / F.when(F.col(f"s.std_{c}") == 0, 1.0).otherwise(F.col(f"s.std_{c}"))
        for c in RFM
    }
    return with_one_row(rfm, scaling(rfm), "s").withColumns(z).drop("s")


def _distance(centre: list[float], columns: list[Column]) -> Column:
    parts = [(x - F.lit(float(v))) * (x - F.lit(float(v))) for x, v in zip(columns, centre)]
    return parts[0] + parts[1] + parts[2]


def nearest_centre(centres: list[list[float]], columns: list[Column]) -> Column:
    """Number of the nearest centre as a built-in expression; the lower number on a tie."""
    ranked = [F.struct(_distance(c, columns).alias("d"), F.lit(i).alias("c")) for i, c in enumerate(centres)]
    return F.least(*ranked).getField("c") if len(ranked) > 1 else F.lit(0)


def assign_clusters(scaled: DataFrame, centres: list[list[float]]) -> DataFrame:
    return scaled.withColumn("cluster", nearest_centre(centres, [F.col(c) for c in SCALED]))


@dataclass(frozen=True)
class Start:
    """One run of K-Means."""

    k: int
    seed: int


def _points(scaled: DataFrame) -> DataFrame:
    """Distinct scaled rows with their number ``n``; missing values have no place, so rows that lack one are left out."""
    return scaled.dropna(subset=SCALED).groupBy(*SCALED).agg(F.count(F.lit(1)).cast("double").alias("n"))


def _draws(points: np.ndarray, run: Start, step: int) -> np.ndarray:
    """A number in (0, 1] of each point that depends on the point, the run and the step only, so that a task can be repeated."""
    mixed = np.full(len(points), np.uint64((run.seed * 0x9E3779B97F4A7C15 + run.k * 0xD1B54A32D192ED03 + step * 0x8CB92BA72F3D8DD7) & (2**64 - 1)))
    for column in (points + 0.0).T:  # minus zero is zero
        mixed = (mixed ^ np.ascontiguousarray(column).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(29)
    return ((mixed >> np.uint64(11)).astype(float) + 1.0) / float(1 << 53)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((points[:, None, :] - centres[None, :, :]) ** 2).sum(2)


#: Points that are compared with all centres at a time.
STRIP = 8192


def _passes(kept: DataFrame, each: Callable[[np.ndarray, np.ndarray], list[tuple]], finish: Callable[[list[tuple]], list[tuple]], columns: str) -> DataFrame:
    """Rows that tasks make of their points: ``each`` of a strip of points and weights, ``finish`` of all that gave."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for batch in batches:
            values = batch.to_numpy(dtype=float)
            for at in range(0, len(values), STRIP):
                rows = finish(rows + each(values[at : at + STRIP, :3], values[at : at + STRIP, 3]))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in columns.split(", ")])

    return kept.select(*SCALED, "n").mapInPandas(run, columns)


def _merged(rows: list[tuple]) -> list[tuple]:
    """Rows (run, cluster, sums...) added up by run and cluster."""
    if not rows:
        return rows
    table = np.array(rows)
    keys, at = np.unique(table[:, :2], axis=0, return_inverse=True)
    sums = np.zeros((len(keys), table.shape[1] - 2))
    np.add.at(sums, at.reshape(-1), table[:, 2:])
    return [(int(r), int(c), *row) for (r, c), row in zip(keys, sums.tolist())]


def _assigned(kept: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per run an array (k, 5) of weight, coordinate sums and cost of its clusters, all in one job of at most that many rows a task."""

    def each(points: np.ndarray, n: np.ndarray) -> list[tuple]:
        rows = []
        for run, own in centres.items():
            d = _distances(points, own)
            nearest = d.argmin(1)
            weights = [n, *(n * points.T), n * d[np.arange(len(d)), nearest]]
            sums = np.array([np.bincount(nearest, w, len(own)) for w in weights]).T
            rows += [(run, c, *row) for c, row in enumerate(sums.tolist())]
        return rows

    sums = ("weight", "s0", "s1", "s2", "cost")
    made = _passes(kept, each, _merged, "run int, cluster int, " + ", ".join(f"{c} double" for c in sums))
    out = {run: np.zeros((len(own), 5)) for run, own in centres.items()}
    for row in made.groupBy("run", "cluster").agg(*[F.sum(c).alias(c) for c in sums]).collect():  # a row per centre
        out[row["run"]][row["cluster"]] = [row[c] for c in sums]
    return out


def _seeded(kept: DataFrame, runs: list[Start], rounds: int) -> dict[int, np.ndarray]:
    """First centres of all runs by k-means||: points drawn in proportion to their cost, weighed, and thinned to k.

    The first point of a run is the one of the smallest draw.  A round is two jobs for all runs together: the costs,
    then the draws of about 2 k points a run.
    """

    def least(points: np.ndarray, n: np.ndarray) -> list[tuple]:
        rows = []
        for i, run in enumerate(runs):
            u = _draws(points, run, -1)
            rows.append((i, float(u.min()), *points[u.argmin()].tolist()))
        return rows

    def smallest(rows: list[tuple]) -> list[tuple]:
        return list({r[0]: r for r in sorted(rows, reverse=True)}.values())

    point = "run int, draw double, " + ", ".join(f"{c} double" for c in SCALED)
    first = _passes(kept, least, smallest, point).groupBy("run").agg(F.min(F.struct("draw", *SCALED)).alias("p")).collect()
    chosen = {r["run"]: np.array([[r["p"][c] for c in SCALED]]) for r in first}
    for step in range(rounds):
        cost = {run: sums[:, 4].sum() for run, sums in _assigned(kept, chosen).items()}

        def drawn(points: np.ndarray, n: np.ndarray) -> list[tuple]:
            rows = []
            for i, own in chosen.items():
                share = 2 * runs[i].k * n * _distances(points, own).min(1) / cost[i] if cost[i] > 0 else np.zeros(len(points))
                u = _draws(points, runs[i], step)
                rows += [(i, float(u[j]), *points[j].tolist()) for j in np.flatnonzero(u < share)]
            return rows

        for row in sorted(_passes(kept, drawn, list, point).collect()):  # about 2 k rows a run
            chosen[row["run"]] = np.vstack([chosen[row["run"]], [[row[c] for c in SCALED]]])
    weight = {run: sums[:, 0] for run, sums in _assigned(kept, chosen).items()}
    return {i: _thinned(chosen[i], weight[i], runs[i]) for i in chosen}


def _thinned(points: np.ndarray, weight: np.ndarray, run: Start) -> np.ndarray:
    """k of the weighed points by k-means++ and some rounds of averaging; fewer where there are fewer."""
    random = np.random.default_rng([run.seed, run.k])
    points, at = np.unique(points, axis=0, return_inverse=True)
    weight = np.bincount(at.reshape(-1), weight)
    points, weight = points[weight > 0], weight[weight > 0]
    picked = [int(random.choice(len(points), p=weight / weight.sum()))]
    while len(picked) < min(run.k, len(points)):
        far = weight * _distances(points, points[picked]).min(1)
        picked.append(int(random.choice(len(points), p=far / far.sum())))
    centres = points[picked]
    for _ in range(30):
        nearest = _distances(points, centres).argmin(1)
        total = np.bincount(nearest, weight, len(centres))
        sums = np.array([np.bincount(nearest, weight * column, len(centres)) for column in points.T]).T
        centres = np.where(total[:, None] > 0, sums / np.maximum(total, 1e-300)[:, None], centres)
    return centres


def fit_starts(
    scaled: DataFrame, runs: list[Start], steps: int | None = None, tolerance: float = 1e-4, rounds: int = 2
) -> list[tuple[float, np.ndarray]]:
    """Inertia and centres of every run of K-Means over ``scaled``, all of them together.

    Equal rows are merged first.  Each round is one job for all runs that still move: tasks return one row per centre
    with the sums of its points.  A run stops when no centre moves by more than ``tolerance``; a cluster that loses all
    points keeps its centre.  A centre that moves further lowers the cost by its weight times the square of the way, so
    every run ends, but the rounds grow with clusters and rows: there is no limit unless ``steps`` sets one, after which
    runs that still move raise.  No points raise, too.
    """
    kept = durable(_points(scaled), "points").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres = _seeded(kept, runs, rounds)
        if not centres:
            raise ValueError("there are no points to cluster")
        moving = set(centres)
        for done in itertools.count(1):
            for run, sums in _assigned(kept, {run: centres[run] for run in sorted(moving)}).items():
                new = np.where(sums[:, :1] > 0, sums[:, 1:4] / np.maximum(sums[:, :1], 1e-300), centres[run])
                if ((new - centres[run]) ** 2).sum(1).max() <= tolerance**2:
                    moving.discard(run)
                centres[run] = new
            if not moving:
                break
            if done == steps:
                raise ArithmeticError(f"{len(moving)} runs of K-Means still move after {steps} rounds")
        costs = {run: float(sums[:, 4].sum()) for run, sums in _assigned(kept, centres).items()}
        return [(costs[i], centres[i]) for i in range(len(runs))]
    finally:
        kept.unpersist()


def fit_segments(rfm: DataFrame, k: int = 4, seed: int = 42, n_init: int = 10) -> SegmentModel:
    """Scale, cluster and name; keeps the best of ``n_init`` runs, which are fitted together."""
    stats = scaling(rfm).first()
    cost, best = min(fit_starts(scale_rfm(rfm), [Start(k, seed + i) for i in range(n_init)]), key=lambda f: f[0])
    centres = best.tolist()
    assigned = assign_clusters(scale_rfm(rfm), centres)
    names = label_clusters(cluster_profiles(assigned), k).collect()  # k rows
    return SegmentModel(
        means=[stats[f"mean_{c}"] for c in RFM],
        stds=[stats[f"std_{c}"] for c in RFM],
        centres=centres,
        segments={row["cluster"]: row["segment"] for row in names},
        inertia=float(cost),
    )


def inertia(assigned: DataFrame, centres: list[list[float]]) -> DataFrame:
    """Sum of squared distances to the own centre."""
    columns = [F.col(c) for c in SCALED]
    return assigned.agg(F.sum(F.least(*[_distance(c, columns) for c in centres])).alias("inertia"))


def refine_centres(scaled: DataFrame, centres: list[list[float]], steps: int) -> DataFrame:
    """Centres after ``steps`` rounds of assignment and averaging from ``centres``: cluster, customers and a column per feature.

    A round is one aggregation to k rows; a cluster that loses all its rows is dropped.
    """
    for _ in range(steps):
        means = assign_clusters(scaled, centres).groupBy("cluster").agg(
            F.count(F.lit(1)).alias("customers"), *[F.avg(c).alias(c) for c in SCALED]
        ).orderBy("cluster").collect()  # k rows
        centres = [[row[c] for c in SCALED] for row in means]
    rows = [(i, row["customers"], *centre) for i, (row, centre) in enumerate(zip(means, centres))]
    return scaled.sparkSession.createDataFrame(rows, "cluster int, customers bigint, " + ", ".join(f"{c} double" for c in SCALED))


def elbow_curve(rfm: DataFrame, ks: range = range(1, 11), seed: int = 42, n_init: int = 10) -> DataFrame:
    """Smallest inertia for each number of clusters: ``(k, inertia)``.

    One cluster has its cost in closed form; all runs of the others are fitted together.
    """
    scaled = scale_rfm(rfm)
    runs = [Start(k, seed + i) for k in ks if k > 1 for i in range(n_init)]
    cost: dict[int, float] = {}
    for run, (c, _) in zip(runs, fit_starts(scaled, runs) if runs else []):
        cost[run.k] = min(c, cost.get(run.k, c))
    if 1 in ks:
        cost[1] = scaled.agg(sum(F.var_pop(c) * F.count(c) for c in SCALED)).first()[0]
    return rfm.sparkSession.createDataFrame(sorted(cost.items()), "k int, inertia double")


def cluster_profiles(assigned: DataFrame) -> DataFrame:
    """Mean of every feature per cluster."""
    known = [c for c in [*RFM, "return_ratio"] if c in assigned.columns]
    return assigned.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in known])


def label_clusters(profiles: DataFrame, k: int = 4) -> DataFrame:
    """Segment names from the profiles of exactly four clusters: ``(cluster, segment)``.

    By mean monetary value the highest is High-Value and the next Regular; of
    the two lowest the one with the longer mean recency is At-Risk and the
    other Occasional (the lowest on a tie).
    """
    if k != 4:
        raise ValueError("segment names are defined for four clusters")
    by_value = Window.orderBy("monetary", "cluster")  # k rows
    ranked = profiles.select(
        "cluster",
        F.row_number().over(by_value).alias("place"),
        F.col("recency"),
        F.lead("recency").over(by_value).alias("above"),
        F.lag("recency").over(by_value).alias("below"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("profiles"),
    )
    segment = (
        F.when(F.col("profiles") != 4, F.raise_error(F.concat(F.lit("segment names need four profiles, not "), "profiles")))
        .when(F.col("place") == 4, "High-Value")
        .when(F.col("place") == 3, "Regular")
        .when(F.col("place") == 2, F.when(F.col("below") > F.col("recency"), "Occasional").otherwise("At-Risk"))
        .otherwise(F.when(F.col("recency") > F.col("above"), "At-Risk").otherwise("Occasional"))
    )
    return ranked.select("cluster", segment.alias("segment"))


def attach_segments(assigned: DataFrame, labels: DataFrame) -> DataFrame:
    """Segment names on customers; ``labels`` has one row per cluster."""
    return assigned.join(F.broadcast(labels), "cluster", "left")


def score_segments(inputs: DataFrame, model: SegmentModel) -> DataFrame:
    """Cluster and segment for ``(recency, frequency, monetary)`` rows.

    Inputs are not capped.  Everything is a built-in expression over literals,
    so any number of rows is scored in one stage.
    """
    z = [
        (_log(c) - F.lit(m)) / F.lit(s if s != 0 else 1.0)
        for c, m, s in zip(RFM, model.means, model.stds)
    ]
    cluster = nearest_centre(model.centres, z)
    name = F.lit("Regular")
    for number, segment in model.segments.items():
        name = F.when(F.col("cluster") == number, segment).otherwise(name)
    return inputs.withColumn("cluster", cluster).withColumn("segment", name)


def _silhouettes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(batches), ignore_index=True)  # the fixed-size sample
    x = rows[SCALED].to_numpy(dtype=float)
    numbers, own = np.unique(rows["cluster"].to_numpy(), return_inverse=True)
    counts = np.bincount(own)
    member = np.eye(len(numbers))[own]
    out = np.zeros(len(x))
    step = max(1, 1_000_000 // max(1, len(x)))
    for start in range(0, len(x), step):
        part = slice(start, min(start + step, len(x)))
        gap = np.sqrt(((x[part, None, :] - x[None, :, :]) ** 2).sum(axis=2))
        totals = gap @ member
        mine = own[part]
        at = np.arange(len(mine))
        inside = totals[at, mine] / np.maximum(counts[mine] - 1, 1)
        means = totals / counts
        means[at, mine] = np.inf
        outside = means.min(axis=1)
        worst = np.maximum(inside, outside)
        score = np.where(worst > 0, (outside - inside) / np.where(worst > 0, worst, 1), 0.0)
        out[part] = np.where(counts[mine] > 1, score, 0.0)
    yield pd.DataFrame({"cluster": numbers[own], "score": out})


def silhouette_sample(assigned: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """Mean Euclidean silhouette of a seeded sample of ``n`` customers.

    Distances are taken inside the sample, whose size is the operator's
    argument and not that of the data.
    """
    sample = sample_exact(assigned.select("customer_id", "cluster", *SCALED), n, ["customer_id"], seed)
    scores = sample.drop("customer_id").coalesce(1).mapInPandas(_silhouettes, "cluster int, score double")
    return scores.agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("silhouette"))


def segment_summary(customers: DataFrame) -> DataFrame:
    """Means per segment and number of customers."""
    wanted = [*RFM, "return_ratio", "expected_purchases", "predicted_clv"]
    known = [c for c in wanted if c in customers.columns]
    return customers.groupBy("segment").agg(
        *[F.avg(c).alias(c) for c in known], F.count(F.lit(1)).alias("customers")
    )


def segment_distribution(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("segment").agg(F.count(F.lit(1)).alias("customers")).orderBy(F.desc("customers"), "segment")
    )


def kpi_summary(customers: DataFrame) -> DataFrame:
    """Customers, high-value share, mean recency and mean spend, one row."""
    high = F.count_if(F.col("segment") == "High-Value")
    total = F.count(F.lit(1))
    return customers.agg(
        total.alias("customers"),
        high.alias("high_value"),
        F.try_divide(high * 100, total).alias("high_value_pct"),
        F.avg("recency").alias("mean_recency"),
        F.avg("monetary").alias("mean_monetary"),
    )


def segment_points(customers: DataFrame, n: int = 3000, seed: int = 42) -> DataFrame:
    """Recency, frequency, monetary value and segment of a seeded sample."""
    columns = ["customer_id", *RFM, "segment"]
    return sample_exact(customers.select(*columns), n, ["customer_id"], seed)


def segment_notes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEGMENT_NOTES, "segment string, profile string, action string")


def with_segment_notes(customers: DataFrame) -> DataFrame:
    """Profile text and suggested action per customer."""
    return customers.join(F.broadcast(segment_notes(customers.sparkSession)), "segment", "left")
