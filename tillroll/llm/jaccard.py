"""Exact similarity join of documents by the Jaccard similarity of their word n-grams, with vertical partitioning.

The global order of n-grams is by the number of distinct sets that hold them, then by hash.  Three steps:

1. A set that links with another shares at least PERCENT of its n-grams with it, so it has few that no other set holds.
   N-grams of a first part of the hash space (SHARE of it) are dealt to buckets, packed, and counted; sets that have too
   many of their own there already can't link and go.  No link is lost by this whatever the part; most sets are decided
   by it.
2. The n-grams of what is left are counted whole and ordered.  Two linked sets share one of the first
   (size - least overlap + 1) n-grams of each, so only these prefixes are posted; n-grams of one set are skipped.
3. The order is cut in FRAGMENTS at quantiles of the posted n-grams, and each set in its segments.  Sets that meet in a
   list are compared in cells (see ``cells``): a task gets the segments of a cell's sets fragment by fragment, counts
   each fragment's partial overlaps by itself, and adds them up per pair.  Only a forest over the links and each set's
   number of links leave it.

N-grams are 64-bit hashes; otherwise the join is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.cells import add_overlaps, cells_of, forest, hot_from, posts_of, with_counted
from tillroll.llm.common import join_groups, narrowed, release_shuffles, stored, text_or_empty
from tillroll.llm.memory import groups_of
from tillroll.llm.minhash import components
from tillroll.llm.shingles import shingle_sets

#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
FRAGMENTS = 8
#: The first part of the hash space, in sixteenths.
SHARE = 7
#: n-grams of a bucket of the hash space, about, and characters of a group of texts whose n-grams are packed together.
BUCKET_GRAMS = 1 << 20
CHARACTERS = 8_000_000
_U = np.uint64


def set_id(hashes: np.ndarray) -> int | None:
    """A number for a set of n-grams, None for the empty one."""
    if not len(hashes):
        return None
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(docs: DataFrame, columns: dict[str, str], make) -> DataFrame:
    """``make(id, hashes)`` gives a row of ``columns`` for every row (doc_id, text) of ``docs``, or None for no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups_of(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                made = [make(doc, s) for (doc, _), s in zip(group, shingle_sets([text for _, text in group]))]
                made = [row for row in made if row is not None]
                if made:
                    yield pa.RecordBatch.from_pydict(dict(zip(columns, map(list, zip(*made)))), schema=schema)

    arrow = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(name, arrow[kind]) for name, kind in columns.items()])
    small = docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"))
    return small.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in columns.items()))


def _lone_posts(docs: DataFrame, share: int, buckets: int) -> DataFrame:
    """The n-grams of the first part of the hash space as packed rows, one per group of texts and bucket of the hash space.

    ``grams`` of one set of the group alone come with their ``nodes`` and how many each has (``sizes``); for those that
    several of its sets hold, ``shared``, that is all there is to know, so a frequent one is sent once per group.
    ``texts`` numbers the group.
    """
    width = _U((share << 60) // buckets + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for group in groups_of(((None, text) for text in batch.column(0).to_pylist()), CHARACTERS):
                number += 1
                parts = {}
                for some in groups_of(group):  # hashing needs about fifty bytes a character for a moment
                    for hashes in shingle_sets([text for _, text in some]):
                        if len(hashes):
                            # a copy, as a part would keep the whole set
                            parts[set_id(hashes)] = hashes if share > 15 else hashes[: np.searchsorted(hashes, _U(share << 60))].copy()
                nodes = np.array(list(parts), np.int64)
                grams = np.concatenate([*parts.values(), np.zeros(0, _U)])
                owner = np.repeat(np.arange(len(nodes)), [len(p) for p in parts.values()])
                order = np.argsort(grams, kind="stable")
                grams, owner = grams[order], owner[order]
                starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.zeros(0, int)
                once = np.diff(np.append(starts, len(grams))) == 1
                lone, shared = starts[once], grams[starts[~once]]
                grams, owner = grams[lone], owner[lone]
                bucket = (grams // width).astype(np.int64)
                order = np.lexsort((owner, bucket))
                grams, owner, bucket = grams[order], owner[order], bucket[order]
                found = np.unique(np.concatenate([bucket, (shared // width).astype(np.int64)]))
                cuts = np.searchsorted(bucket, np.append(found, buckets))
                shared_cuts = np.searchsorted((shared // width).astype(np.int64), np.append(found, buckets))
                rows = []
                for i, b in enumerate(found):
                    own, n = np.unique(owner[cuts[i] : cuts[i + 1]], return_counts=True)
                    packed = (grams[cuts[i] : cuts[i + 1]], nodes[own], n.astype("<u4"), shared[shared_cuts[i] : shared_cuts[i + 1]])
                    rows.append((int(b), number, *[part.tobytes() for part in packed]))
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*rows)))), schema=schema)

    schema = pa.schema([("bucket", pa.int64()), ("texts", pa.int64())] + [(n, pa.binary()) for n in ("grams", "nodes", "sizes", "shared")])
    columns = "bucket long, texts long, grams binary, nodes binary, sizes binary, shared binary"
    return docs.select(text_or_empty("text").alias("text")).mapInArrow(run, columns)


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each value of the first column, without it; rows come in its order."""
    held, rows = None, []
    for batch in batches:
        for key, *row in zip(*(batch.column(i).to_pylist() for i in range(len(batch.schema)))):
            if key != held:
                if rows:
                    yield rows
                held, rows = key, []
            rows.append(row)
    if rows:
        yield rows


def alone_counts(docs: DataFrame, share: int, buckets: int, partitions: int) -> DataFrame:
    """node, alone: how many n-grams of the first part of the hash space each set holds alone; sets without any have no row.

    A bucket answers each group of texts in one row, and a group adds up its answers.
    """

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches):
            grams, nodes, sizes, shared = (np.frombuffer(b"".join(c), t) for c, t in zip(list(zip(*rows))[1:], ("<u8", "<i8", "<u4", "<u8")))
            place = np.repeat(np.arange(len(nodes)), sizes)  # a set of a group of texts
            order = np.argsort(grams, kind="stable")
            grams, place = grams[order], place[order]
            starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.zeros(0, int)
            if not len(starts):
                continue
            # copies of a text in several groups hold an n-gram as one set
            single = np.minimum.reduceat(nodes[place], starts) == np.maximum.reduceat(nodes[place], starts)
            single &= ~np.isin(grams[starts], shared)
            n = np.bincount(place[np.repeat(single, np.diff(np.append(starts, len(grams))))], minlength=len(nodes))
            ends = np.cumsum([len(row[2]) // 8 for row in rows])
            out = [(row[0], own[k > 0].tobytes(), k[k > 0].astype("<u4").tobytes()) for row, own, k in zip(rows, np.split(nodes, ends), np.split(n, ends))]
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*out)))), schema=schema)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches):
            nodes, n = (np.frombuffer(b"".join(c), t) for c, t in zip(zip(*rows), ("<i8", "<u4")))
            nodes, at = np.unique(nodes, return_inverse=True)
            alone = np.bincount(at, n, len(nodes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(alone)], names=["node", "alone"])

    schema = pa.schema([("texts", pa.int64()), ("nodes", pa.binary()), ("counts", pa.binary())])
    posts = _lone_posts(docs, share, buckets).repartition(partitions, "bucket").sortWithinPartitions("bucket")
    answered = posts.mapInArrow(answers, "texts long, nodes binary, counts binary").repartition(partitions, "texts").sortWithinPartitions("texts")
    # every group that holds a set has its whole count
    return answered.mapInArrow(totals, "node long, alone long").groupBy("node").agg(F.max("alone").alias("alone"))


def open_classes(docs: DataFrame, classes: DataFrame, percent: int = PERCENT, share: int = SHARE) -> DataFrame:
    """The rows of ``classes`` (node, n_shingles) that the first part of the hash space doesn't decide."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    alone = alone_counts(docs, share, max(partitions, -(-total * share // 16 // BUCKET_GRAMS)), partitions)
    left = classes.join(alone, "node", "left").filter(100 * (F.col("n_shingles") - F.coalesce("alone", F.lit(0))) >= percent * F.col("n_shingles"))
    return left.drop("alone")


def segments(docs: DataFrame, classes: DataFrame, percent: int = PERCENT, fragments: int = FRAGMENTS) -> DataFrame:
    """node, n_shingles, entries, prefix and parts (segment by fragment) of the sets that may link.

    ``classes`` has node, n_shingles and first_doc, a document that holds the set.
    """
    wanted = classes.select(F.col("node").alias("wanted"), F.col("first_doc").alias("doc_id"))
    texts = narrowed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), wanted, "doc_id").join(wanted, "doc_id")
    # a document may hold several sets: each of its rows gives the one that it has
    sets = _sets(texts.select(F.col("wanted").alias("doc_id"), "text"), {"node": "long", "grams": "array<long>"}, lambda node, s: (node, s.view(np.int64)) if set_id(s) == node else None)
    sets = stored(sets, "open-sets")
    if sets.count() > classes.count():  # rows that repeat a document
        sets = stored(sets.dropDuplicates(["node"]), "open-sets")
    posts = sets.select("node", F.explode("grams").alias("gram"))
    counts = stored(posts.groupBy("gram").agg(F.count("*").alias("posted")).filter("posted > 1"), "gram-counts")
    shared = with_counted(posts, counts, "gram", hot_from(classes.count()))

    # the place of an n-gram in the order as a number; cuts need not be exact, but the same everywhere
    place = F.col("posted") + (F.shiftrightunsigned(F.col("gram"), 12) / F.lit(float(1 << 52)))
    shares = [i / fragments for i in range(1, fragments)]
    cuts = counts.agg(F.percentile_approx(place, F.array(*[F.lit(s) for s in shares]), F.lit(1000)).alias("cuts")).first()["cuts"] or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = batch.column(2)
            starts = np.concatenate(([0], np.cumsum(found.value_lengths().to_numpy())))
            items = found.flatten()
            counted, grams = (items.field(i).to_numpy() for i in (0, 1))
            rows = []
            for i, (node, n) in enumerate(zip(nodes, sizes)):
                own_n, own = counted[starts[i] : starts[i + 1]], grams[starts[i] : starts[i + 1]]
                # n-grams of this set alone come first in the order and meet nothing
                least = -(-percent * n // 100)
                length = n - least + 1 - (n - len(own))
                if length <= 0:
                    continue
                order = np.lexsort((own.view(_U), own_n))
                own_n, own = own_n[order], own[order]
                at = np.searchsorted(cuts, own_n + (own.view(_U) >> _U(12)) / float(1 << 52), "right")
                parts = [np.sort(own[at == f].view(_U)).tobytes() or None for f in range(fragments)]
                rows.append((node, n, len(own), own[:length], parts))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary())))],
                    names=["node", "n_shingles", "entries", "prefix", "parts"],
                )

    gathered = shared.groupBy("node").agg(F.collect_list(F.struct("posted", "gram")).alias("found"))
    return (
        gathered.join(classes.select("node", "n_shingles"), "node")
        .select("node", "n_shingles", "found")
        .mapInArrow(run, "node long, n_shingles long, entries long, prefix array<long>, parts array<binary>")
    )


class _Cell:
    """Partial overlaps of one cell, added up fragment by fragment."""

    def __init__(self, low: int, high: int, percent: int):
        self.same, self.low, self.percent = low == high, low, percent
        self.sides: list[dict] = [{}, {}]  # node -> (place, n, copies)
        self.total = None
        self.fragment, self.parts = None, ([], [])

    def add(self, block, fragment, node, n, copies, part) -> None:
        side = 0 if block == self.low else 1
        if fragment < 0:  # every node comes once before the first segment
            self.sides[side][node] = (len(self.sides[side]), n, copies)
            return
        if fragment != self.fragment:
            self._count()
            self.fragment = fragment
        values = np.frombuffer(part, "<u8")
        self.parts[side].append((np.full(len(values), self.sides[side][node][0]), values))

    def _count(self) -> None:
        if self.total is None:
            self.total = np.zeros((len(self.sides[0]), len(self.sides[0 if self.same else 1])), np.int32)
        left, right = self.parts[0], self.parts[0 if self.same else 1]
        if left and right:
            add_overlaps(self.total, *[tuple(np.concatenate(c) for c in zip(*side)) for side in (left, right)])
        self.parts = ([], [])

    def found(self) -> Iterator[tuple]:
        """(a, b, None) of a forest over the links, (node, None, links) of every node that has any."""
        self._count()
        left, right = self.sides[0], self.sides[0 if self.same else 1]
        (l_node, l_n, l_copies), (r_node, r_n, r_copies) = (
            (np.array(list(side), np.int64), *np.array([[v[1], v[2]] for v in side.values()], np.int64).reshape(-1, 2).T) for side in (left, right)
        )
        linked = 100 * self.total >= self.percent * (l_n[:, None] + r_n[None, :] - self.total)
        if self.same:
            np.fill_diagonal(linked, False)
        for a, b in forest(linked, l_node, r_node):
            yield a, b, None
        degrees = [(l_node, linked @ r_copies)]
        if not self.same:
            degrees.append((r_node, l_copies @ linked))
        for nodes, n in degrees:
            yield from ((int(node), None, int(k)) for node, k in zip(nodes, n) if k)


def compared(cells: DataFrame, percent: int = PERCENT) -> DataFrame:
    """What ``_Cell.found`` gives for every cell; ``cells`` has low, high, block, node, n_shingles, copies and parts."""
    spark = cells.sparkSession
    header = F.array(F.struct(F.lit(-1).alias("fragment"), F.lit(None).cast("binary").alias("part")))
    pieces = F.filter(F.transform("parts", lambda p, i: F.struct(i.alias("fragment"), p.alias("part"))), lambda s: s["part"].isNotNull())
    rows = cells.select("low", "high", "block", "node", "n_shingles", "copies", F.explode(F.concat(header, pieces)).alias("s"))
    rows = rows.select("low", "high", "block", F.col("s.fragment").alias("fragment"), "node", "n_shingles", "copies", F.col("s.part").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b", "links"])

        held, cell = None, None
        for batch in batches:
            found: list[tuple] = []
            for low, high, *row in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if (low, high) != held:
                    if cell is not None:
                        found += cell.found()
                    held, cell = (low, high), _Cell(low, high, percent)
                cell.add(*row)
            if found:
                yield out(found)
        if cell is not None and (found := list(cell.found())):
            yield out(found)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))  # merged by bytes, products of large cells would share a task
    return (
        rows.repartition(partitions, "low", "high")
        .sortWithinPartitions("low", "high", "fragment", "block", "node")
        .mapInArrow(run, "a long, b long, links long")
    )


def jaccard_join(docs: DataFrame, percent: int = PERCENT, fragments: int = FRAGMENTS) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (linked rows, copies included) of every row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored.  A null text counts as empty; texts without words are
    linked with nothing and are their own component.  Each row is linked by its own text, also where rows share a
    doc_id: component_id is the smallest doc_id among the rows that links reach.  Rows without doc_id are linked only
    by an equal set; if no row of a component has a doc_id, component_id is null.  An empty table gives no rows.
    """
    rows = stored(
        _sets(docs, {"doc_id": "long", "n_shingles": "long", "node": "long"}, lambda doc, s: (doc, len(s), set_id(s))), "set-ids"
    )
    classes = stored(
        rows.filter("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("copies")
        ),
        "classes",
    )
    named = classes.filter("first_doc IS NOT NULL")
    may_link = stored(open_classes(docs, named, percent), "open-classes")
    release_shuffles(docs.sparkSession)
    cut = stored(segments(docs, may_link, percent, fragments), "segments")
    release_shuffles(docs.sparkSession)
    posts = posts_of(cut.select("node", F.explode("prefix").alias("key")), cut.count())
    cells = cells_of(posts, cut.select("node", "entries"))
    carried = cut.join(may_link.select("node", "copies"), "node").select("node", "n_shingles", "copies", "parts")
    links = stored(compared(cells.join(carried, "node"), percent), "links")

    reach = components(links.filter("b IS NOT NULL").select("a", "b"))
    degree = links.filter("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    grouped = stored(
        classes.join(reach, "node", "left").join(degree, "node", "left").select(
            "node", "copies", "first_doc", F.coalesce("component", "node").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "grouped",
    )
    least = stored(grouped.groupBy("component").agg(F.min("first_doc").alias("least"), F.count("*").alias("posted")), "least")
    ends = with_counted(grouped, least, "component", hot_from(grouped.count()))
    ends = stored(ends.select(F.col("node").cast("string").alias("node"), F.col("copies").alias("class_size"), "least", "n_links"), "ends")
    keyed = rows.select("doc_id", "n_shingles", F.coalesce(F.col("node").cast("string"), F.concat(F.lit("none "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("node"))
    joined = join_groups(keyed, ends, "node", "class_size", "doc_id")
    linked = F.col("n_shingles") > 0
    return joined.select(
        "doc_id", "n_shingles", F.when(linked, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )
