"""Counting pairs that occur together, and finding nearest rows.

Both are products of a sparse matrix with its transpose, cut so that no task
ever holds or emits an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.ids import with_integer_ids
from tillroll.functions.sparseblocks import Product, row_strips
from tillroll.session import durable

# A group of more members than this is not joined with itself.
LARGE_GROUP = 512
# Pairs that one task of that join makes, about: its map-side sum holds a row for each of them that differs.
TASK_PAIRS = 1 << 23
# Items per side of a block, and groups per slab, for the large groups.
BLOCK_ITEMS = 1024
SLAB_GROUPS = 1024
# Pairs that groups make, per pair of items there is, from which on pairs of blocks of items are summed in one task each;
# items of such a block at most, whose table takes 8 bytes a pair; products added at a time.
MET_OFTEN = 2
SUMMED_ITEMS = 4096
BLOCK_PRODUCTS = 1 << 21
# Rows and entries of a block for nearest rows. A row is sent once per block, in bundles of so many rows and entries at most.
BLOCK_ROWS = 1 << 18
BLOCK_ENTRIES = 3 << 22
BUNDLE_ROWS, BUNDLE_ENTRIES = 512, 1 << 17
# Rows and entries of a block that are multiplied at a time; the product is held in strips of a set size.
TILE_ROWS, TILE_ENTRIES = 1 << 15, 1 << 20


def _block_counts(cell: pd.DataFrame) -> pd.DataFrame:
    """All non-zero sums of one cell: items of block i against items of block j."""
    i, j = int(cell["i"].iloc[0]), int(cell["j"].iloc[0])
    group = pd.factorize(cell["grp"])[0]
    sizes = cell["items"].map(len).to_numpy()
    dim = np.repeat(group, sizes)
    item = np.concatenate(cell["items"].to_numpy())
    weight = np.concatenate(cell["weights"].to_numpy())
    block = np.repeat(cell["block"].to_numpy(), sizes)
    square = np.concatenate(cell["squares"].to_numpy()) if "squares" in cell else None

    def side(b: int):
        mine = block == b
        ids, at, row = np.unique(item[mine], return_index=True, return_inverse=True)
        return ids, (row, dim[mine], weight[mine]), None if square is None else square[mine][at]

    left_ids, left, left_squares = side(i)
    right_ids, right, right_squares = side(j) if j != i else (left_ids, left, left_squares)
    found = []
    for first, strip in row_strips(left, right, len(left_ids), len(right_ids)):
        r, c = np.nonzero(strip)
        a, b = left_ids[r + first], right_ids[c]
        keep = a < b
        pairs = {"a": a[keep], "b": b[keep], "together": strip[r, c][keep]}
        if square is not None:
            pairs |= {"square_a": left_squares[r + first][keep], "square_b": right_squares[c][keep]}
        found.append(pd.DataFrame(pairs))
    if not found:
        names = ["a", "b", "together", *(["square_a", "square_b"] if square is not None else [])]
        return pd.DataFrame({n: [] for n in names}).astype({"a": "int64", "b": "int64"})
    return pd.concat(found, ignore_index=True)


def _met_blocks(large_rows: DataFrame, slabs: Column, carried: list[str]) -> DataFrame:
    """Each group's items of a block, once for every block that the group has items in, with the pair of blocks (i, j)."""
    packed = large_rows.groupBy("grp", "block").agg(F.collect_list(F.struct("item", "weight", *carried)).alias("m"))
    present = large_rows.groupBy("grp").agg(F.collect_set("block").alias("present"))
    sent = packed.join(present, "grp").select(
        F.pmod(F.xxhash64("grp"), slabs).alias("slab"),
        "grp",
        "block",
        F.col("m.item").alias("items"),
        F.col("m.weight").alias("weights"),
        *[F.col(f"m.{c}").alias(f"{c}s") for c in carried],
        F.explode("present").alias("other"),
    )
    return sent.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def _as_bundle(columns: dict[str, np.ndarray | pa.Array]) -> bytes:
    """Arrays of different lengths, compressed."""
    table = pa.table({name: pa.LargeListArray.from_arrays(pa.array([0, len(v)]), v if isinstance(v, pa.Array) else pa.array(v)) for name, v in columns.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_bundle(bundle: bytes) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(bundle).read_all()
    return {name: table.column(name).chunk(0).flatten().to_numpy(zero_copy_only=False) for name in table.column_names}


def _dealt_to_blocks(n_blocks: int):
    """For each pair of blocks of items, what the groups of a batch have in both.

    An item's block is the rest of its number, so numbers with gaps fill blocks alike; in its block it has the quotient.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("m")
            sizes = np.diff(lists.offsets.to_numpy())
            inside = lists.flatten()
            grp = np.repeat(np.arange(len(sizes)), sizes)
            item, *carried = (inside.field(k).to_numpy(zero_copy_only=False) for k in range(inside.type.num_fields))
            order = np.lexsort((item, grp, item % n_blocks))
            grp, item, carried = grp[order], item[order], [c[order] for c in carried]
            blocks, start = np.unique(item % n_blocks, return_index=True)
            ends = np.append(start[1:], len(item))
            counts = [np.bincount(grp[s:e], minlength=len(sizes)) for s, e in zip(start, ends)]

            def side(k: int, met: np.ndarray) -> dict[str, np.ndarray]:
                at = start[k] + np.flatnonzero(met[grp[start[k] : ends[k]]])
                own = {"sizes": counts[k][met], "items": (item[at] // n_blocks).astype(np.int32), "weights": carried[0][at]}
                if len(carried) > 1:
                    own["squared"], first = np.unique(own["items"], return_index=True)
                    own["squares"] = carried[1][at][first]
                return own

            for x in range(len(blocks)):
                for y in range(x, len(blocks)):
                    met = (counts[x] > 0) & (counts[y] > 0) if x < y else counts[x] > 1
                    if met.any():
                        columns = {f"l_{c}": v for c, v in side(x, met).items()}
                        if x < y:
                            columns |= {f"r_{c}": v for c, v in side(y, met).items()}
                        yield pa.RecordBatch.from_pydict({"i": blocks[x : x + 1], "j": blocks[y : y + 1], "bundle": [_as_bundle(columns)]})

    return run


def _summed_blocks(n_blocks: int, block_items: int, carried: bool):
    """The sums of a pair of blocks, from all its bundles: one row per pair of items, however many groups there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = {}
        for batch in batches:
            for r in batch.to_pylist():
                if (r["i"], r["j"]) not in cells:
                    cells[r["i"], r["j"]] = np.zeros(block_items**2), np.zeros((2, block_items))
                sums, squares = cells[r["i"], r["j"]]
                found, same = _from_bundle(r["bundle"]), r["i"] == r["j"]
                for k, mark in enumerate("ll" if same else "lr"):
                    if carried:
                        squares[k][found[f"{mark}_squared"]] = found[f"{mark}_squares"]
                _add_groups(sums, block_items, found, same)
        for (i, j), (sums, squares) in cells.items():
            at = np.flatnonzero(sums)
            for some in range(0, len(at), 1 << 16):
                here = at[some : some + (1 << 16)]
                a, b = np.divmod(here, block_items)
                ends = [squares[0][a], squares[1][b]] if carried else []
                a, b = a * n_blocks + i, b * n_blocks + j
                swap = a > b
                both = ((a, b), tuple(ends)) if carried else ((a, b),)
                ordered = [c for x, y in both for c in (np.where(swap, y, x), np.where(swap, x, y))]
                columns = [*ordered, sums[here]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _sum_names(carried))

    return run


def _sum_names(carried: bool) -> list[str]:
    return ["a", "b", *(["square_a", "square_b"] if carried else []), "together"]


def _add_groups(sums: np.ndarray, width: int, found: dict[str, np.ndarray], same: bool) -> None:
    """Products of each group's items on the left with those on the right; within a block, with the later ones."""
    sizes, items, weights = found["l_sizes"], found["l_items"], found["l_weights"]
    r_sizes, r_items, r_weights = (sizes, items, weights) if same else (found["r_sizes"], found["r_items"], found["r_weights"])
    end = np.repeat(np.cumsum(r_sizes), sizes)
    start = np.arange(len(items)) + 1 if same else end - np.repeat(r_sizes, sizes)
    n = end - start
    reached = np.cumsum(n)
    at = 0
    while at < len(items):
        done = reached[at - 1] if at else 0
        last = max(at + 1, int(np.searchsorted(reached, done + BLOCK_PRODUCTS, side="right")))
        part = slice(at, last)
        hit = _spans(start[part], n[part])
        cell = np.repeat(items[part].astype(np.int64) * width, n[part])
        cell += r_items[hit]
        product = np.repeat(weights[part], n[part])
        product *= r_weights[hit]
        np.add.at(sums, cell, product)
        at = last


def _sums_of_blocks(members: DataFrame, items: int) -> DataFrame:
    """Sums over groups for all pairs of items numbered below ``items``, each pair in one task and once.

    Items are cut in blocks; a group's items go to each pair of blocks that it has items in, in compressed bundles, and a
    task adds up one pair of blocks as they come, in a table of its items. What is exchanged grows with the members times
    the blocks, not with the pairs.
    """
    spark = members.sparkSession
    blocks = min(max(-(-items // SUMMED_ITEMS), _least_blocks(2 * spark.sparkContext.defaultParallelism)), items)
    block_items = -(-items // blocks)
    carried = "square" in members.columns
    inside = [F.col("item").cast("bigint").alias("item"), F.col("weight").cast("double").alias("weight")]
    packed = members.groupBy("grp").agg(F.collect_list(F.struct(*inside, *(["square"] if carried else []))).alias("m"))
    dealt = packed.select("m").mapInArrow(_dealt_to_blocks(blocks), "i bigint, j bigint, bundle binary")
    number = F.expr("CAST(j * (j + 1) / 2 + i AS INT)")
    kinds = ", ".join(f"{c} {'bigint' if c in 'ab' else 'double'}" for c in _sum_names(carried))
    return dealt.repartitionById(blocks * (blocks + 1) // 2, number).mapInArrow(_summed_blocks(blocks, block_items, carried), kinds)


def co_occurrence(
    members: DataFrame,
    large_group: int = LARGE_GROUP,
    block_items: int = BLOCK_ITEMS,
    slab_groups: int = SLAB_GROUPS,
    task_pairs: int = TASK_PAIRS,
) -> DataFrame:
    """Sums over groups of weight(a) * weight(b), for all pairs a < b that meet.

    ``members`` has one row per ``(grp, item, weight)``; ``item`` is a number
    from ``with_integer_ids``.  The result ``(a, b, together)`` is whole and
    exact.  Where the groups make more than ``MET_OFTEN`` times as many pairs as there are items to pair, sums of a task
    would still be exchanged once per task and pair: there, each pair of blocks of items is summed in one task, see
    ``_sums_of_blocks``.  Otherwise groups are treated by size:

    * A group of up to ``large_group`` members is joined with itself.  Its
      pairs are bounded, and they go straight into the map-side sum.  They are dealt
      to so many tasks that each makes about ``task_pairs`` of them at most.
    * A larger group (a wholesaler, one giant invoice) never meets itself in
      one task.  Its items are cut in blocks by number, and the groups in slabs;
      a task gets two blocks of one slab, multiplies them, and returns one
      row per item pair, however many groups the slab holds.  A block of a
      group's items is sent as often as the group has blocks.

    A column ``square`` that belongs to the item travels along, and comes back
    as ``square_a`` and ``square_b``: the pairs, the largest table here, then
    need no join for it.

    ``members`` is read by several branches, so it is stored first.
    """
    members = durable(members, "members")
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max("item").alias("last"))
    large = sizes.filter(F.col("n") > large_group).select("grp")

    # a number of partitions by the pairs: AQE would merge them by the bytes going in, but
    # far more rows come out of the join
    made = sizes.agg(
        F.sum(F.expr(f"IF(n <= {large_group}, n * (n - 1) div 2, 0)")), F.sum(F.expr("n * (n - 1D) / 2")), F.max("last")
    ).first()
    pairs, all_pairs, last = made[0] or 0, made[1] or 0.0, made[2] or 0
    items = members.select("item").distinct().count()
    if all_pairs > MET_OFTEN * items * (items - 1) / 2:
        return _sums_of_blocks(members, last + 1)
    partitions = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // task_pairs))
    small_rows = members.join(large, "grp", "left_anti").repartition(partitions, "grp")
    carried = ["square"] if "square" in members.columns else []
    ends = ["square_a", "square_b"] if carried else []
    left, right = (
        small_rows.select("grp", F.col("item").alias(s), F.col("weight").alias(f"w{s}"), *[F.col(c).alias(f"{c}_{s}") for c in carried])
        for s in "ab"
    )
    from_small = (
        left.join(right, "grp")
        .filter(F.col("a") < F.col("b"))
        .select("a", "b", (F.col("wa") * F.col("wb")).alias("together"), *ends)
    )

    block = F.floor(F.col("item") / block_items).cast("int")
    large_rows = members.join(large, "grp", "left_semi").withColumn("block", block)
    slabs = F.greatest(F.ceil(large.agg(F.count(F.lit(1))).scalar() / slab_groups), F.lit(1))
    packed = _met_blocks(large_rows, slabs, carried)
    from_large = packed.groupBy("slab", "i", "j").applyInPandas(
        _block_counts, ", ".join(["a bigint, b bigint, together double", *[f"{e} double" for e in ends]])
    )
    return (
        from_small.unionByName(from_large)
        .groupBy("a", "b", *ends)
        .agg(F.sum("together").alias("together"))
    )


def both_ways(pairs: DataFrame, swap: list[tuple[str, str]], same: list[str]) -> DataFrame:
    """Each unordered pair as two rows; ``swap`` names the columns that trade places."""
    kept = [(c, c) for c in same]
    forth = [(x, x) for pair in swap for x in pair] + kept
    back = [(x, y) for p, q in swap for x, y in ((p, q), (q, p))] + kept
    forth, back = (", ".join(f"'{name}', {column}" for name, column in part) for part in (forth, back))
    return pairs.selectExpr(f"inline(array(named_struct({forth}), named_struct({back})))")


def _places(keys: np.ndarray) -> np.ndarray:
    """Larger for keys that come first: what decides between equal similarities."""
    place = np.empty(len(keys), dtype=np.int64)
    place[np.argsort(keys, kind="stable")] = np.arange(len(keys))[::-1]
    return place


def _found_in(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The position of each key among ``known``, -1 for those that aren't there."""
    order = np.argsort(known, kind="stable")
    at = order[np.minimum(np.searchsorted(known[order], keys), len(known) - 1)]
    return np.where(known[at] == keys, at, -1)


#: Groups of a strip's columns: the ``n``-th largest of their maxima is a lower bound of a row's ``n``-th best.
COLUMN_GROUPS = 256


class _Best:
    """The best ``n`` others of each row, of those offered so far."""

    def __init__(self, rows: int, place: np.ndarray, n: int):
        self.n, self.place = n, place
        self.scale = 1 << int(len(place)).bit_length()
        self.least = np.full(rows, np.finfo(float).tiny)
        self.kept = tuple(np.zeros(0, dtype=t) for t in ("int64", "int64", "float64"))
        self.offered, self.waiting = [], 0

    def offer(self, row: np.ndarray, other: np.ndarray, similarity: np.ndarray) -> None:
        self.offered.append((row, other, similarity))
        self.waiting += len(row)
        if self.waiting > max(1 << 16, self.n * len(self.least)):
            self.settle()

    def settle(self, later: bool = False) -> None:
        """Keep ``n`` of each row, and learn what others must reach.

        With ``later``, only others of later places come from now on: they have to be better by more than rounding.
        """
        row, other, similarity = (np.concatenate(p) for p in zip(self.kept, *self.offered))
        rank = np.rint(similarity * 1e9).astype(np.int64) * self.scale + self.place[other]
        order = np.lexsort((-rank, row))
        row, other, similarity = row[order], other[order], similarity[order]
        count = np.bincount(row, minlength=len(self.least))
        at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        last = at == self.n - 1
        self.least[row[last]] = (np.rint(similarity[last] * 1e9) + (0.49 if later else -1)) / 1e9
        keep = at < self.n
        self.kept = row[keep], other[keep], similarity[keep]
        self.offered, self.waiting = [], 0


def _offer_rows(best: _Best, strip: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
    """Cells of a strip that can be among the best of its rows; only groups of columns that hold such are looked at."""
    height, width = strip.shape
    size = -(-width // COLUMN_GROUPS)
    whole = width // size
    parts = [(0, strip[:, : whole * size].reshape(height, whole, size))]
    if whole * size < width:
        parts.append((whole * size, strip[:, None, whole * size :]))
    most = [p.max(axis=2) for _, p in parts]
    least = best.least[rows]
    joined = most[0] if len(most) == 1 else np.concatenate(most, axis=1)
    if joined.shape[1] >= best.n:
        some = joined.shape[1] - best.n
        least = np.maximum(least, np.partition(joined, some, axis=1)[:, some] - 1e-8)
    for (start, part), top in zip(parts, most):
        row, group = np.nonzero(top >= least[:, None])
        cells = part[row, group]
        hit, inside = np.nonzero(cells >= least[row][:, None])
        if len(hit):
            best.offer(rows[row[hit]], columns[start + group[hit] * part.shape[2] + inside], cells[hit, inside])


def _offer_columns(best: _Best, strip: np.ndarray, columns: np.ndarray, rows: np.ndarray) -> None:
    """Cells of a strip that can be among the best of its columns' rows."""
    height, width = strip.shape
    least = best.least[columns]
    at = np.flatnonzero(strip.max(axis=0) >= least)
    if not len(at):
        return
    cells, least = strip[:, at], least[at]
    if height > best.n and len(at) * 8 > width:
        least = np.maximum(least, np.partition(cells, height - best.n, axis=0)[height - best.n] - 1e-8)
    row, hit = np.nonzero(cells >= least)
    best.offer(columns[at[hit]], rows[row], cells[row, hit])


def _best_rows(l_key: np.ndarray, left: tuple, r_key: np.ndarray, right: tuple, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left rows, right rows and similarity of the best ``n`` right rows of each left row."""
    best = _Best(len(l_key), _places(r_key), n)
    _Meeting(_found_in(l_key, r_key), best).offer(left, right, np.arange(len(l_key)), np.arange(len(r_key)))
    best.settle()
    return best.kept


def _chosen(side: tuple, some: np.ndarray) -> tuple:
    """The triples of some rows, numbered anew."""
    row, dim, weight = side
    mine = some[row]
    return (np.cumsum(some) - 1)[row[mine]], dim[mine], weight[mine]


def _undecided(least: np.ndarray, length: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and others to set apart, so that no product of the lengths of those that stay reaches a row's least; about the fewest."""
    able = least / np.maximum(length, np.finfo(float).tiny)
    cuts = np.quantile(others, np.linspace(0, 1, 65), method="lower")
    apart = np.searchsorted(np.sort(able), cuts, side="right") / len(able)
    apart += 1 - np.searchsorted(np.sort(others), cuts, side="right") / len(others)
    cut = cuts[np.argmin(apart)]
    return able <= cut, others > cut


class _Meeting:
    """Two tiles whose product is offered to the rows of the left one, and with ``r_best`` to those of the right one.

    ``own`` is a left row's number among the others of its side, or -1; the tiles begin at ``l_first`` and ``r_first`` of theirs.
    """

    def __init__(self, own: np.ndarray, l_best: _Best, r_best: _Best | None = None, l_first: int = 0, r_first: int = 0):
        self.own, self.l_best, self.r_best = own, l_best, r_best
        self.l_first, self.r_first = l_first, r_first

    def offer(self, left: tuple, right: tuple, rows: np.ndarray, columns: np.ndarray) -> None:
        """Offer the product of some rows of both tiles.

        Where a row's ``n``-th best of what it has met exceeds all that the dims of many rows can add, the others decide
        whether a cell is looked at, and only cells that they reach are. Other rows and columns are multiplied whole.
        """
        product = Product(left, right, len(rows), len(columns))
        bounds = product.head_bounds()
        row_least = self.l_best.least[rows]
        column_least = self.r_best.least[columns] if self.r_best else np.full(len(columns), np.inf)
        low_rows, low_columns = row_least <= bounds[0], column_least <= bounds[1]
        low = low_rows.mean() + low_columns.mean()
        if low:
            by_row, long_columns = _undecided(row_least, product.l_length, product.r_length)
            by_column, long_rows = _undecided(column_least, product.r_length, product.l_length)
            low_rows, low_columns = by_row | long_rows, by_column | long_columns
            low = low_rows.mean() + low_columns.mean()
        if low == 0:
            self._reached(product.cells_above(row_least, column_least), rows, columns)
        elif low > 0.5:
            self._whole(product, rows, columns)
        else:
            parts = ((low_rows, np.ones(len(columns), dtype=bool)), (~low_rows, low_columns), (~low_rows, ~low_columns))
            for offer, (mine, others) in zip((self._part, self._part, self.offer), parts):
                if mine.any() and others.any():
                    offer(_chosen(left, mine), _chosen(right, others), rows[mine], columns[others])

    def _part(self, left: tuple, right: tuple, rows: np.ndarray, columns: np.ndarray) -> None:
        self._whole(Product(left, right, len(rows), len(columns)), rows, columns)

    def _whole(self, product: Product, rows: np.ndarray, columns: np.ndarray) -> None:
        for first, strip in product.strips():
            mine = rows[first : first + len(strip)]
            itself = self.own[mine] - self.r_first
            at = np.minimum(np.searchsorted(columns, itself), len(columns) - 1)
            met = np.flatnonzero(columns[at] == itself)
            strip[met, at[met]] = 0.0  # a row is no neighbour of itself
            _offer_rows(self.l_best, strip, mine, columns + self.r_first)
            if self.r_best is not None:
                _offer_columns(self.r_best, strip, columns, mine + self.l_first)

    def _reached(self, cells: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], rows: np.ndarray, columns: np.ndarray) -> None:
        for row, column, similarity in cells:
            row, column = rows[row], columns[column]
            other = self.own[row] != column + self.r_first
            near = other & (similarity >= self.l_best.least[row])
            self.l_best.offer(row[near], column[near] + self.r_first, similarity[near])
            if self.r_best is not None:
                near = other & (similarity >= self.r_best.least[column])
                self.r_best.offer(column[near], row[near] + self.l_first, similarity[near])


class _Side:
    """The rows of one side of a cell, in the order of their keys."""

    def __init__(self, bundles: list[bytes]):
        parts = [_opened(b) for b in bundles]
        keys = np.concatenate([p[0] for p in parts])
        sizes = np.concatenate([p[1] for p in parts])
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(keys, kind="stable")
        self.keys, self.sizes = keys[order], sizes[order]
        self.starts = starts[order]
        self.dims = np.concatenate([p[2] for p in parts])
        self.weights = np.concatenate([p[3] for p in parts])

    def tiles(self) -> list[tuple[int, int]]:
        """Ranges of rows that are multiplied at a time, small ones first: what these find lets cells of the others be left out."""
        reached = np.cumsum(self.sizes)
        out, first, some = [], 0, TILE_ROWS // 16
        while first < len(self.keys):
            end = int(np.searchsorted(reached, (reached[first - 1] if first else 0) + TILE_ENTRIES, side="right"))
            end = max(first + 1, min(end, first + some))
            out.append((first, end))
            first, some = end, min(2 * some, TILE_ROWS)
        return out

    def tile(self, first: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = self.sizes[first:end]
        at = _spans(self.starts[first:end], sizes)
        return np.repeat(np.arange(end - first), sizes), self.dims[at], self.weights[at]


def _best_of_sides(left: _Side, right: _Side | None, n: int, both: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, keys of neighbours and similarities: of the left rows, and with ``both`` of the right ones as well.

    Without a right side the rows of the left meet each other. A product of two tiles serves the rows of both; tiles come
    in the order of the keys, as ``_Best`` wants them.
    """
    alone = right is None
    right = left if alone else right
    l_place, r_place = (np.arange(len(s.keys))[::-1] for s in (left, right))
    if alone:
        own = np.arange(len(left.keys))
    else:
        own = np.full(len(left.keys), -1) if both else _found_in(left.keys, right.keys)
    r_bests = {}
    for l_first, l_end in left.tiles():
        asking, l_best = left.tile(l_first, l_end), _Best(l_end - l_first, r_place, n)
        for r_first, r_end in right.tiles():
            if alone and r_first < l_first:
                continue
            r_best = None
            if both or (alone and r_first != l_first):
                r_best = r_bests.setdefault(r_first, _Best(r_end - r_first, l_place, n))
            meeting = _Meeting(own[l_first:l_end], l_best, r_best, l_first, r_first)
            meeting.offer(asking, right.tile(r_first, r_end), np.arange(l_end - l_first), np.arange(r_end - r_first))
            for best in (l_best, r_best):
                if best is not None:
                    best.settle(later=True)
        row, other, similarity = l_best.kept
        yield left.keys[row + l_first], right.keys[other], similarity
    for r_first, best in r_bests.items():
        row, other, similarity = best.kept
        yield right.keys[row + r_first], left.keys[other], similarity


_BUNDLES = "key bigint, asks boolean, n_rows bigint, entries bigint, bundle binary"


def _bundled(rows: int, entries: int):
    """Rows as compressed bundles of so many rows or entries at most: what is exchanged and held for cells.

    Dims are ordered in a row and kept as differences, weights as numbers of the bundle's distinct ones where these are few.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        waiting = {False: [], True: []}

        def bundle(asks: bool) -> pa.RecordBatch:
            nonlocal made
            parts = list(zip(*waiting[asks]))
            waiting[asks] = []
            columns = dict(zip(("lengths", "sizes", "dims"), map(np.concatenate, parts[1:4])))
            values, coded = np.unique(weights := np.concatenate(parts[4]), return_inverse=True)
            few = len(values) < len(weights) // 2
            columns |= {"values": values, "coded": coded.astype(np.int32)} if few else {"weights": weights}
            made += 1
            row = {"key": (task << 32) + made, "asks": asks, "n_rows": len(columns["sizes"]), "entries": len(weights)}
            row["bundle"] = _as_bundle({"keys": pa.concat_arrays(parts[0])} | columns)
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            lists = batch.column("v")
            sizes = np.diff(lists.offsets.to_numpy())
            inside = lists.flatten()
            row = np.repeat(np.arange(len(sizes)), sizes)
            dims, weights = (inside.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            order = np.lexsort((dims, row))
            dims, weights = dims[order], weights[order]
            change = np.diff(dims, prepend=0)
            starts = np.cumsum(sizes) - sizes
            change[starts[sizes > 0]] = dims[starts[sizes > 0]]
            for kind in (False, True):
                at = np.flatnonzero(asks == kind)
                while len(at):
                    room = rows - sum(len(w[2]) for w in waiting[kind])
                    space = entries - sum(len(w[3]) for w in waiting[kind])
                    few = int(np.searchsorted(np.cumsum(sizes[at]), space, side="right"))
                    take, at = np.split(at, [min(room, few) if waiting[kind] else max(1, min(room, few))])
                    if len(take):
                        cells = _spans(starts[take], sizes[take])
                        keys = batch.column("key").take(pa.array(take))
                        waiting[kind].append((keys, lengths[take], sizes[take], change[cells], weights[cells]))
                    if len(at):
                        yield bundle(kind)
        for kind in (False, True):
            if waiting[kind]:
                yield bundle(kind)

    return run


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the entries of some rows."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _opened(bundle: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, numbers of entries, dims and weights of a bundle's rows."""
    found = _from_bundle(bundle)
    sizes, dims = found["sizes"], np.cumsum(found["dims"])
    starts = np.cumsum(sizes) - sizes
    # a row's first dim is whole, so what was reached before it comes off again
    dims -= np.repeat(np.concatenate([[0], dims])[starts], sizes)
    if len(dims) and dims.max() < 1 << 31:
        dims = dims.astype(np.int32)
    weights = found["values"][found["coded"]] if "coded" in found else found["weights"]
    return found["keys"], sizes, dims, weights / np.repeat(found["lengths"], sizes)


def _best_of_cells(n: int, output_columns: list[str]):
    """The best ``n`` of each row of one block (``lb``) among those of another (``rb``), for the cells of a partition.

    Bundles of a cell carry ``first`` (of the left block) and ``second``; with ``both`` set, the right rows get their best left
    ones as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = {}
        for batch in batches:
            for r in batch.select(["lb", "rb", "first", "second", "both", "bundle"]).to_pylist():
                first, second, one, _ = cells.setdefault((r["lb"], r["rb"]), ([], [], [], r["both"]))
                (one if r["first"] and r["second"] else first if r["first"] else second).append(r["bundle"])
        while cells:
            first, second, one, both = cells.popitem()[1]
            if one:
                found = _best_of_sides(_Side(one), None, n, False)
            elif first and second:
                found = _best_of_sides(_Side(first), _Side(second), n, both)
            else:
                continue
            for columns in found:
                yield from pa.table([pa.array(c) for c in columns], names=output_columns).to_batches(1 << 16)

    return run


def _own_block(count: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(count)).cast("int")


def _every_block(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def _paired_blocks(packed: DataFrame, blocks: int) -> DataFrame:
    """Cells of two blocks each, every pair of blocks once: a row is sent once per block."""
    placed = packed.select("*", _own_block(blocks).alias("own"), _every_block(blocks).alias("other"))
    return placed.select(
        *packed.columns,
        F.least("own", "other").alias("lb"),
        F.greatest("own", "other").alias("rb"),
        (F.col("own") <= F.col("other")).alias("first"),
        (F.col("own") >= F.col("other")).alias("second"),
        (F.col("own") != F.col("other")).alias("both"),
    )


def _crossed_blocks(asking: DataFrame, packed: DataFrame, left_blocks: int, right_blocks: int) -> DataFrame:
    """Cells of a block of asking rows and a block of all rows."""
    left = asking.select("*", _own_block(left_blocks).alias("lb"), _every_block(right_blocks).alias("rb"), F.lit(True).alias("first"))
    right = packed.select("*", _every_block(left_blocks).alias("lb"), _own_block(right_blocks).alias("rb"), F.lit(False).alias("first"))
    return left.unionByName(right).withColumns({"second": ~F.col("first"), "both": F.lit(False)})


def nearest_rows(
    vectors: DataFrame,
    key: str,
    dim: str,
    weight: str,
    n: int,
    targets: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    block_entries: int = BLOCK_ENTRIES,
    numbered_length: str | None = None,
) -> DataFrame:
    """The ``n`` rows most similar to each target row: ``(key, neighbor, similarity, rank)``.

    ``vectors`` holds sparse rows of unit length as ``(key, dim, weight)``, so a
    similarity is a sum of products.  Dims that a single row has meet nothing and
    aren't sent.  Rows are packed, compressed in bundles and cut into blocks of about ``block_rows`` rows,
    or of ``block_entries`` entries if that is less; a task gets two blocks,
    multiplies them and returns only the best ``n`` per row.  Where all rows ask,
    a pair of blocks meets once and serves the rows of both, so a row is sent once
    per block; with ``targets``, blocks of targets meet blocks of rows.  A dim that all rows
    share (a best-seller, a common word) costs a task no more than its two blocks, and
    what is exchanged afterwards is ``n`` rows per row and block.  The row
    itself and rows with nothing in common are left out; equal similarities
    (to 9 decimals) are ordered by key.  With ``numbered_length``, a column whose quotient the weights are, dims are numbers already
    and those of single rows left out; ``vectors`` that lie by their key are then packed where they lie.
    """
    if numbered_length:
        rows = _rows(vectors, key, dim, weight, F.first(numbered_length))
    else:
        vectors = durable(vectors.select(key, dim, weight), "vectors")
        shared = vectors.groupBy(dim).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(dim)
        dims = with_integer_ids(shared, dim, "dim_id")
        rows = _rows(vectors.join(dims, dim), key, "dim_id", weight, F.lit(1.0))
    asks = F.lit(False)
    if targets is not None:
        wanted = targets.select(F.col(key).alias("key")).distinct().withColumn("wanted", F.lit(True))
        rows, asks = rows.join(wanted, "key", "left"), F.col("wanted").isNotNull()
    return _nearest(rows.select("key", asks.alias("asks"), "length", "v"), key, n, targets is not None, block_rows, block_entries)


def _rows(entries: DataFrame, key: str, dim_id: str, weight: str, length: Column) -> DataFrame:
    """Packed rows ``(key, length, v)``."""
    entry = F.struct(F.col(dim_id).cast("bigint").alias("dim_id"), F.col(weight).alias("w"))
    return entries.groupBy(F.col(key).alias("key")).agg(F.collect_list(entry).alias("v"), length.alias("length"))


def _nearest(rows: DataFrame, key: str, n: int, asked: bool, block_rows: int, block_entries: int) -> DataFrame:
    spark = rows.sparkSession
    few, less = min(BUNDLE_ROWS, block_rows), min(BUNDLE_ENTRIES, block_entries)
    packed = durable(rows.mapInArrow(_bundled(few, less), _BUNDLES), "packed")

    def needed(bundles: DataFrame) -> int:
        blocks = F.greatest(F.ceil(F.sum("n_rows") / block_rows), F.ceil(F.sum("entries") / block_entries), F.lit(1))
        return int(bundles.agg(blocks).first()[0] or 1)

    if not asked:
        # fewer blocks would leave cores without a cell
        blocks = max(needed(packed), _least_blocks(spark.sparkContext.defaultParallelism))
        cells, count, number = _paired_blocks(packed, blocks), blocks * (blocks + 1) // 2, F.expr("CAST(rb * (rb + 1) / 2 + lb AS INT)")
    else:
        asking = packed.filter("asks")
        left_blocks, right_blocks = needed(asking), needed(packed)
        cells, count = _crossed_blocks(asking, packed, left_blocks, right_blocks), left_blocks * right_blocks
        number = (F.col("lb") * right_blocks + F.col("rb")).cast("int")
    kind = rows.schema["key"].dataType.simpleString()
    # a task gets one cell
    best = cells.repartitionById(count, number).mapInArrow(
        _best_of_cells(n, [key, "neighbor", "similarity"]), f"{key} {kind}, neighbor {kind}, similarity double"
    )
    order = Window.partitionBy(key).orderBy(F.desc(F.round("similarity", 9)), "neighbor")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _least_blocks(tasks: int) -> int:
    """The smallest number of blocks of which so many pairs can be made, a block with itself included."""
    blocks = 1
    while blocks * (blocks + 1) // 2 < tasks:
        blocks += 1
    return blocks
