"""Near duplicates by an inverted join of MinHash coordinates.

Every document gets COORDINATES minima over its shingle set; documents with equal sets are one class from then on.  A
class is posted under each coordinate-value pair.  Values that no other class has can't collide, and a class with fewer
than MATCHES shared values can't reach the match threshold: both are dropped.  Of what is left, rarest first, two
classes that match MATCHES times must share one of the first (shared - MATCHES + 1) values of each, so only those
prefixes are posted and the frequent rest is skipped.

Classes that meet under a posted value are compared in cells (see ``cells``): a task gets the signatures of two blocks of
classes that met, counts collisions of all coordinates, confirms the pairs over the match threshold on full sets and
returns a forest over the links, so that a group of any size leaves rows in proportion to its members.  The chance to
miss a pair at the similarity threshold is 3e-6, and falls quickly above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.cells import add_overlaps, cells_of, forest, hot_from, posts_of, with_counted
from tillroll.llm.common import join_groups, maybe_among, narrowed, release_shuffles, stored, text_or_empty
from tillroll.llm.memory import groups_of
from tillroll.llm.shingles import mix, shingle_sets

COORDINATES = 64
MATCHES = 32
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75

_U = np.uint64
_random = np.random.Generator(np.random.PCG64(17))
_FACTOR = _random.integers(1, 1 << 63, COORDINATES, dtype=_U) * _U(2) + _U(1)
_OFFSET = _random.integers(0, 1 << 63, COORDINATES, dtype=_U)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each coordinate, its lowest bits replaced by the coordinate's number: a coordinate-value pair."""
    least = np.full(COORDINATES, ~_U(0))
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096, None] * _FACTOR + _OFFSET
        np.minimum(least, block.min(0), out=least)
    return (mix(least) & ~_U(COORDINATES - 1)) | np.arange(COORDINATES, dtype=_U)


def digest_of(hashes: np.ndarray) -> str | None:
    """The name of a set; the empty one has none."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).hexdigest() if len(hashes) else None


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_digest (null for empty sets) and keys, the signature, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups_of(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                sets = shingle_sets([text for _, text in group])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc for doc, _ in group], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest_of(s) for s in sets]),
                        pa.array([signature(s).view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_digest", "keys"],
                )

    return docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, set_digest string, keys array<long>"
    )


def prefixes(classes: DataFrame, total: int) -> DataFrame:
    """node, n_shingles, keys (shared values, rarest first) and prefix of each class that can match another."""
    posts = classes.select("node", F.explode("keys").alias("key"))
    counts = stored(posts.groupBy("key").agg(F.count("*").alias("posted")).filter("posted > 1"), "minhash-counts")
    shared = with_counted(posts, counts, "key", hot_from(total))
    gathered = (
        shared.groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("posted", "key"))).alias("found"))  # COORDINATES at most
        .filter(F.size("found") >= MATCHES)
        .select("node", F.transform("found", lambda f: f["key"]).alias("shared"))
    )
    return gathered.select("node", "shared", F.expr(f"slice(shared, 1, size(shared) - {MATCHES} + 1)").alias("prefix"))


def compared(cells: DataFrame) -> DataFrame:
    """a, b: a forest over the links inside each cell; ``cells`` has low, high, block, node, keys and hashes."""

    def links(low: int, high: int, rows: list[tuple]) -> Iterator[tuple[int, int]]:
        sides = []
        for block in (low, high):
            own = [row[1:] for row in rows if row[0] == block]
            nodes, keys, hashes = zip(*own)
            sides.append((np.array(nodes), np.array(keys), [np.frombuffer(h, "<u8") for h in hashes]))
        (l_node, l_keys, l_sets), (r_node, r_keys, r_sets) = sides
        collisions = np.zeros((len(l_node), len(r_node)), np.int16)
        for i in range(COORDINATES):
            collisions += l_keys[:, i, None] == r_keys[None, :, i]
        open_pairs = collisions >= MATCHES
        if low == high:
            np.fill_diagonal(open_pairs, False)
        left, right = np.flatnonzero(open_pairs.any(1)), np.flatnonzero(open_pairs.any(0))
        if not len(left):
            return
        both = np.zeros((len(left), len(right)), np.int32)
        sizes = [np.array([len(sets[i]) for i in some]) for sets, some in ((l_sets, left), (r_sets, right))]
        values = [np.concatenate([sets[i] for i in some]) for sets, some in ((l_sets, left), (r_sets, right))]
        add_overlaps(both, *[(np.repeat(np.arange(len(n)), n), v) for n, v in zip(sizes, values)])
        linked = open_pairs[np.ix_(left, right)] & (100 * both >= PERCENT * (sizes[0][:, None] + sizes[1][None, :] - both))
        yield from forest(linked, l_node[left], r_node[right])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows, found = None, [], []
        for batch in batches:
            for low, high, *row in zip(*(batch.column(c).to_pylist() for c in range(6))):
                if (low, high) != cell:
                    if rows:
                        found += links(*cell, rows)
                    cell, rows = (low, high), []
                rows.append(row)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
                found = []
        if rows and (found := list(links(*cell, rows))):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    partitions = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # merged by bytes, large cells would share a task
    return (
        cells.select("low", "high", "block", "node", "keys", "hashes")
        .repartition(partitions, "low", "high")
        .sortWithinPartitions("low", "high")
        .mapInArrow(run, "a long, b long")
    )


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node in ``links`` (a, b).

    Each round takes the smallest label of the neighbours and then the label's own label; a chain halves each time.
    """
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    while True:
        labels = stored(labels, "labels")
        heard = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("jumped"))
        new = stored(
            labels.join(heard, "node").join(jump, "component", "left")
            .select("node", F.least("component", "heard", "jumped").alias("component"), F.col("component").alias("before")),
            "labels",
        )
        labels = new.select("node", "component")
        if new.filter("component < before").isEmpty():
            return labels


def one_set_each(classes: DataFrame) -> DataFrame:
    """The rows of ``classes`` that have the smallest set_digest of their node; ``classes`` must be stored."""
    ranked = classes.groupBy("node").agg(F.min("set_digest").alias("least"), F.count("*").alias("rivals"))
    several = stored(ranked.filter("rivals > 1").select("node", "least"), "rivals")
    marked = maybe_among(classes, several, "node")  # few, where doc_ids are keys: the others aren't exchanged
    best = marked.filter("maybe").join(several, "node", "left").filter("least IS NULL OR least = set_digest")
    return marked.filter("NOT maybe").select(*classes.columns).unionByName(best.select(*classes.columns))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Components of linked documents.

    ``docs`` needs doc_id and text; other columns are ignored.  A null text counts as empty; documents without words
    are linked with nothing.  Rows of one doc_id are taken for one document and all returned; where their texts differ,
    the set of the smallest digest is compared with others.  A row without doc_id can be linked only by an equal set.
    Returns doc_id, n_shingles, component_id, kept for every row; an empty table gives none.
    """
    rows = stored(signed(docs), "signatures")
    classes = stored(
        rows.filter("set_digest IS NOT NULL").groupBy("set_digest").agg(
            F.min("doc_id").alias("node"), F.count("*").alias("class_size"), F.first("n_shingles").alias("entries"), F.first("keys").alias("keys")
        ),
        "classes",
    )
    release_shuffles(docs.sparkSession)
    known = one_set_each(classes.filter("node IS NOT NULL"))
    posted = stored(prefixes(known, known.count()), "prefixes")
    posts = posts_of(posted.select("node", F.explode("prefix").alias("key")), known.count())
    wanted = posts.select("node").distinct()
    release_shuffles(docs.sparkSession)

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups_of(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                sets = shingle_sets([text for _, text in group])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, _ in group], pa.int64()), pa.array([digest_of(s) for s in sets]), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())],
                    names=["node", "set_digest", "hashes"],
                )

    # only rows that may be wanted are exchanged, once for both joins on node
    texts = narrowed(docs.select(F.col("doc_id").cast("long").alias("node"), text_or_empty("text").alias("text")), wanted, "node")
    sets = texts.mapInArrow(full_sets, "node long, set_digest string, hashes binary")
    own = narrowed(known, wanted, "node").select("node", F.col("set_digest").alias("own_digest"), "keys")
    # of digests of one length; an equality would join, and so exchange, by both columns
    sets = sets.join(own, "node").filter("startswith(set_digest, own_digest)").dropDuplicates(["node"])
    cells = cells_of(posts, known.select("node", "entries").join(wanted, "node", "left_semi"))
    label = components(stored(compared(cells.join(sets, "node")), "links"))

    groups = stored(
        classes.join(label, "node", "left").select("set_digest", "class_size", F.coalesce("component", "node").alias("component")), "components"
    )
    filled = rows.select("doc_id", "n_shingles", F.coalesce("set_digest", F.concat(F.lit("none "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("set_digest"))
    placed = join_groups(filled, groups, "set_digest", "class_size", "doc_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all their columns."""
    stay = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("stay_id")).distinct()
    return docs.join(stay, docs["doc_id"].cast("long").eqNullSafe(stay["stay_id"]), "left_semi")
