"""Comparing the members of inverted lists without emitting their pairs.

Two nodes have to be compared when they meet in a list (a shared n-gram of their prefixes, a shared coordinate).  Nodes
are cut into blocks of about BLOCK_NODES whose members meet the same smallest node, so that a group of alike texts lies
in few blocks however many lists it fills.  Blocks that meet in a list make a cell; a task gets a cell's members and
compares them as matrices.  What leaves it is a forest over the links found there, so rows grow with members, not with
pairs, and each pair of nodes is compared in one cell only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import HOT_SHARE, stored

#: Nodes of a block, and entries of their sets together.
BLOCK_NODES = 256
BLOCK_ENTRIES = 1 << 20
#: Rounds in which nodes hear of the smallest node that they meet; more bring blocks together, none changes the result.
ANCHOR_ROUNDS = 2
#: Products of one column of two sparse matrices from which the column is multiplied densely, and columns at a time.
HEAVY, COLUMNS = 256, 2048
#: Products that are added at a time.
PRODUCTS = 1 << 22


def with_counted(rows: DataFrame, counts: DataFrame, key: str, hot_from: float, size: str = "posted") -> DataFrame:
    """Inner join of ``rows`` with ``counts``, one row per key with its number of rows in ``size``.

    Keys with over ``hot_from`` rows are broadcast; their number is bounded by all rows over hot_from.
    """
    hot, cold = counts.filter(F.col(size) > hot_from), counts.filter(F.col(size) <= hot_from)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(others.join(cold, key))


def hot_from(n_rows: int) -> float:
    """Rows of a key from which it counts as hot, among so many rows."""
    return max(100, n_rows * HOT_SHARE)


def posts_of(lists: DataFrame, n_nodes: int) -> DataFrame:
    """key, node of ``lists`` (key, node, no row twice): lists of a single node are left out, and of equal lists all but one.

    Alike sets meet in many lists of the same nodes; which lists are equal is told by size, ends and a 64-bit sum of them.
    """
    told = lists.groupBy("key").agg(
        F.count("*").alias("posted"), F.min("node").alias("low"), F.max("node").alias("high"), F.bit_xor(F.xxhash64("node")).alias("mark")
    )
    kept = told.filter("posted > 1").groupBy("posted", "low", "high", "mark").agg(F.min("key").alias("key"))
    met = stored(kept.select("key", "posted"), "lists")
    return stored(with_counted(lists, met, "key", hot_from(n_nodes)).select("key", "node"), "posts")


def blocks_of(posts: DataFrame, sizes: DataFrame) -> DataFrame:
    """node, block of every node in ``posts`` (key, node); ``sizes`` has node and its entries.  Both must be stored."""
    hot = hot_from(posts.count())
    anchors = posts.select("node").distinct().withColumn("anchor", F.col("node"))
    for _ in range(ANCHOR_ROUNDS):
        heard = posts.join(anchors, "node")
        low = stored(heard.groupBy("key").agg(F.min("anchor").alias("anchor"), F.count("*").alias("posted")), "anchors")
        anchors = stored(with_counted(posts, low, "key", hot).groupBy("node").agg(F.min("anchor").alias("anchor")), "anchors")
    members = stored(anchors.join(sizes, "node"), "anchors")
    pieces = members.groupBy("anchor").agg(
        F.count("*").alias("posted"), F.ceil(F.greatest(F.count("*") / BLOCK_NODES, F.sum("entries") / BLOCK_ENTRIES)).alias("pieces")
    )
    dealt = with_counted(members, stored(pieces, "pieces"), "anchor", hot)
    return dealt.select("node", F.xxhash64("anchor", F.pmod(F.xxhash64("node"), F.col("pieces"))).alias("block"))


def cells_of(posts: DataFrame, sizes: DataFrame) -> DataFrame:
    """low, high, node, block: the members of every pair of blocks that meet in a list, once, low = high included."""
    placed = stored(blocks_of(posts, sizes), "blocks")
    listed = stored(posts.join(placed, "node").select("key", "block").distinct(), "listed")
    many = listed.groupBy("key").count().filter("count > 1").select("key")
    meeting = listed.join(many, "key", "left_semi")
    left, right = meeting.withColumnRenamed("block", "low"), meeting.withColumnRenamed("block", "high")
    across = left.join(right, "key").filter("low < high").select("low", "high").distinct()
    inside = placed.groupBy("block").count().filter("count > 1").select(F.col("block").alias("low"), F.col("block").alias("high"))
    cells = stored(across.unionByName(inside), "cells")
    ends = cells.select("low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    return ends.join(placed, "block").select("low", "high", "node", "block")


def add_overlaps(total: np.ndarray, left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> None:
    """Adds to ``total`` how many values each left row shares with each right row.

    A side is (row, value), with no value twice in a row.  Frequent values are multiplied densely, COLUMNS at a time,
    the others by listing what meets.
    """
    common = np.intersect1d(left[1], right[1])
    if not len(common):
        return
    sides = []
    for row, value in (left, right):
        at = np.minimum(np.searchsorted(common, value), len(common) - 1)
        known = common[at] == value
        order = np.argsort(at[known], kind="stable")
        sides.append((row[known][order], at[known][order]))
    (l_row, l_at), (r_row, r_at) = sides
    l_n, r_n = (np.bincount(at, minlength=len(common)) for at in (l_at, r_at))
    l_start, r_start = np.cumsum(l_n) - l_n, np.cumsum(r_n) - r_n
    heavy = l_n * r_n >= HEAVY
    columns = np.flatnonzero(heavy)
    for first in range(0, len(columns), COLUMNS):
        own = columns[first : first + COLUMNS]
        place = np.full(len(common), -1)
        place[own] = np.arange(len(own))
        dense = []
        for n, (row, at) in zip(total.shape, sides):
            mine = place[at] >= 0
            matrix = np.zeros((n, len(own)), np.float32)
            matrix[row[mine], place[at[mine]]] = 1
            dense.append(matrix)
        total += (dense[0] @ dense[1].T).astype(total.dtype)
    light = np.flatnonzero(~heavy[l_at])
    repeat = r_n[l_at[light]]
    stops = np.cumsum(repeat)
    begin = 0
    while begin < len(light):
        end = max(begin + 1, int(np.searchsorted(stops, (stops[begin - 1] if begin else 0) + PRODUCTS, "right")))
        some, times = light[begin:end], repeat[begin:end]
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        partner = r_row[np.repeat(r_start[l_at[some]], times) + inside]
        flat = np.repeat(l_row[some], times) * total.shape[1] + partner
        total += np.bincount(flat, minlength=total.size).reshape(total.shape).astype(total.dtype)
        begin = end


def forest(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges (smaller, larger) that connect what ``linked`` connects; its rows and columns are the nodes given.

    Each group of connected nodes becomes a tree in the form of a heap, so that no node has more than three edges here.
    """
    nodes, at = np.unique(np.concatenate([rows, columns]), return_inverse=True)
    row_at, column_at = at[: len(rows)], at[len(rows) :]
    open_nodes = np.zeros(len(nodes), bool)
    open_nodes[row_at[linked.any(1)]] = True
    open_nodes[column_at[linked.any(0)]] = True
    for start in range(len(nodes)):
        if not open_nodes[start]:
            continue
        group = np.zeros(len(nodes), bool)
        group[start] = True
        fresh = group.copy()
        while fresh.any():
            heard = np.zeros(len(nodes), bool)
            heard[column_at[linked[fresh[row_at]].any(0)]] = True
            heard[row_at[linked[:, fresh[column_at]].any(1)]] = True
            fresh = heard & ~group
            group |= heard
        open_nodes &= ~group
        members = nodes[group]
        for i in range(1, len(members)):
            yield int(members[(i - 1) // 2]), int(members[i])
