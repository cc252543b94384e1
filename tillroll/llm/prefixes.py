"""The trie of conversation prefixes, built as a burst trie.

Conversations of equal turns become one unit, and a unit's turn ids are cut in chunks of CHUNK.  One chunk at a time,
the distinct chunks under a trie head are the entries of a suffix container.  A container of more than CONTAINER entries
is burst by the next turn id: each id becomes a head with a container of its own.  What is left is dealt by container,
sorted by turn ids and swept into nodes with a stack.  Units that go on are the entries of the next chunk, under the
head where their chunk ends; a unit that is alone there needs no more rounds, as the rest of it is one chain.  Sums over
subtrees then go upwards: each container passes one row to its head.

A shared prefix of any length, a hot first turn or a hot conversation is split like this; what a task holds are a chunk's
ids, the open nodes of a stack and their children within a container.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.cells import hot_from, with_counted
from tillroll.llm.common import numbered, stored

#: Turns of a chunk, and entries from which a container is burst.
CHUNK = 256
CONTAINER = 4096
#: Ids of conversations that are joined to one string.
ENDS = 1000
#: The fold of conversations: the first crc32(id) modulo HEADS turns come from the conversation id - id modulo FAMILY.
HEADS, FAMILY = 4, 20
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)
_NAMES = [column.split()[0] for column in NODE.split(", ")]


def turn_ids(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0 in order of turn, role and text), id and words of every row of ``turns`` with a conv_id."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = numbered(rows, order, "place").select(
        "conv_id", "place",
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("id"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    placed = stored(placed, "turns")
    starts = stored(placed.groupBy("conv_id").agg(F.min("place").alias("start"), F.count("*").alias("n_turns")), "starts")
    found = with_counted(placed, starts, "conv_id", hot_from(placed.count()), "n_turns")
    return found.select("conv_id", (F.col("place") - F.col("start")).alias("pos"), "id", "words")


def rebuilt(turns: DataFrame, heads: int = HEADS, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id) and the turns (conv_id, pos, id, words) that they have after the fold.

    Conversation c takes its first h turns from conversation c - c % family, all if that has fewer and none if there is
    no such conversation; its own turns after the first h follow.
    """
    rows = stored(turn_ids(turns), "turns")
    sizes = stored(rows.groupBy("conv_id").agg(F.count("*").alias("n_turns")), "sizes")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("n_base"))
    convs = sizes.select("conv_id", "n_turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    convs = convs.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stored(convs, "conversations")
    own = with_counted(rows, convs.select("conv_id", "n_turns", "h", "taken"), "conv_id", hot_from(rows.count()), "n_turns")
    own = own.filter("pos >= h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "id", "words")
    first = rows.filter(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "base")
    given = convs.filter("taken > 0").select("conv_id", "base", "taken").join(first, "base").filter("pos < taken")
    return convs.select("conv_id"), own.unionByName(given.select("conv_id", "pos", "id", "words"))


def _runs(members: DataFrame) -> DataFrame:
    """seq, first, last, n and ids, at most ENDS joined numbers, of runs of the ordered members (seq, conv_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = None, []

        def closed():
            return [held, ids[0], len(ids), ",".join(map(str, ids))]

        for batch in batches:
            out = []
            for seq, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if seq != held or len(ids) == ENDS:
                    if ids:
                        out.append(closed())
                    held, ids = seq, []
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out)))), schema=schema)
        if ids:
            yield pa.RecordBatch.from_pydict({name: [v] for name, v in zip(names, closed())}, schema=schema)

    names = ["seq", "conv_id", "n", "ids"]
    schema = pa.schema([("seq", pa.string()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.select("seq", "conv_id").repartitionByRange(partitions, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    return dealt.mapInArrow(run, "seq string, conv_id long, n long, ids string")


def units_of(convs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Conversations of equal turns as one row: conv_id, the smallest, n_convs, length, and the digest of all ids.

    Ids are joined to runs where they lie in order; a task then reads a unit's runs in order and keeps a digest only.
    """
    whole = chunks.groupBy("conv_id").agg(
        F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", F.md5(F.array_join("ids", ",")).alias("digest")))), lambda c: c["digest"]), ",")).alias("seq"),
        F.sum(F.size("ids")).alias("length"),
    )
    members = stored(convs.join(whole, "conv_id", "left").select("conv_id", F.coalesce("seq", F.lit("")).alias("seq"), F.coalesce("length", F.lit(0)).alias("length")), "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, n, digest = None, None, 0, None
        for batch in batches:
            out = []
            for seq, conv, k, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if seq == held:
                    digest.update(b",")
                else:
                    if held is not None:
                        out.append((first, n, digest.hexdigest()))
                    held, first, n, digest = seq, conv, 0, hashlib.sha256()
                digest.update(ids.encode())
                n += k
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*out)))), schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_pydict({"conv_id": [first], "n_convs": [n], "ends": [digest.hexdigest()]}, schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_convs", pa.int64()), ("ends", pa.string())])
    runs = _runs(members).repartition("seq").sortWithinPartitions("seq", "conv_id")
    units = runs.mapInArrow(run, "conv_id long, n_convs long, ends string")
    return units.join(members.select("conv_id", "length"), "conv_id")


def swept(entries: DataFrame) -> DataFrame:
    """Nodes of containers, and one row per container (container not null) with the sums that its head gets.

    ``entries`` has container, head_conv (conv_id of its head), depth (of the head), used (ids above the head), ids, words,
    n_convs, conv_id, ends, and the sums from below an entry's end: children, leaves, saved.
    """

    class Open:
        """A node on the stack."""

        def __init__(self, key, depth, words):
            self.key, self.depth, self.words = key, depth, words
            self.conv, self.n, self.children, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, NO_ENDS
            self.closed: list[tuple] = []  # its children, which lack their parent's conv_id

        def take(self, conv, n, children, leaves, saved):
            self.conv = conv if self.conv is None else min(self.conv, conv)
            self.n += n
            self.children += children
            self.leaves += leaves
            self.saved += saved

        def rows(self, conv):
            return [(c, depth, conv, *rest, None) for c, depth, *rest in self.closed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[Open] = []
        held, head_conv, out = None, None, []

        def close_to(size: int) -> None:
            while len(stack) > size:
                node = stack.pop()
                out.extend(node.rows(node.conv))
                leaves, saved = node.leaves if node.children else 1, node.saved + (node.n - 1) * node.words
                stack[-1].closed.append((node.conv, node.depth, node.n, node.children, leaves, saved, node.ends))
                stack[-1].take(node.conv, node.n, 1, leaves, saved)

        def close_container() -> None:
            if stack:
                close_to(1)
                top = stack.pop()
                out.extend(top.rows(head_conv))
                out.append((None, None, None, None, top.children, top.leaves, top.saved, None, held))

        def batch_out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*out)))), schema=schema)
            out.clear()
            return made

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(batch.schema))]
            for container, conv_above, depth, used, ids, words, n, conv, ends, children, leaves, saved in zip(*columns):
                if container != held:
                    close_container()
                    held, head_conv = container, conv_above
                    stack.append(Open(None, depth, 0))
                suffix, same = ids[used:], 0
                while same < len(suffix) and same + 1 < len(stack) and stack[same + 1].key == suffix[same]:
                    same += 1
                close_to(same + 1)
                for i in range(same, len(suffix)):
                    stack.append(Open(suffix[i], depth + i + 1, words[used + i]))
                stack[-1].take(conv, n, children, leaves, saved)
                if ends is not None:
                    stack[-1].ends = ends
                if len(out) > 20_000:
                    yield batch_out()
        close_container()
        if out:
            yield batch_out()

    schema = pa.schema([(n, pa.string() if n == "ends_sha256" else pa.int64()) for n in _NAMES] + [("container", pa.string())])
    partitions = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = entries.select("container", "head_conv", "depth", "used", "ids", "words", "n_convs", "conv_id", "ends", "children", "leaves", "saved")
    return wanted.repartition(partitions, "container").sortWithinPartitions("container", "ids").mapInArrow(run, f"{NODE}, container string")


def _path(head, ids):
    """The digest that names the node ``ids`` below ``head``."""
    return F.aggregate(ids, head, lambda path, one: F.md5(F.concat(path, one)))


def _burst(entries: DataFrame, heads: DataFrame, depth: int, container: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The containers that are small enough, as a list of their entries, and the heads made by bursting, by level.

    ``entries`` has container, ids, words, n_convs, conv_id, ends; ``heads`` has container, posted (entries), head_conv.
    """
    small, levels, used = [], [], 0
    while True:
        hot = hot_from(entries.count())
        placed = stored(with_counted(entries, heads, "container", hot).withColumns({"depth": F.lit(depth + used), "used": F.lit(used)}), "placed")
        small.append(placed.filter((F.col("posted") <= container) & (F.size("ids") > used)))
        large = placed.filter((F.col("posted") > container) & (F.size("ids") > used))
        if large.isEmpty():
            return small, levels
        one = F.element_at("ids", used + 1)
        moved = stored(
            large.select(
                F.md5(F.concat("container", one)).alias("container"), F.col("container").alias("parent"), F.col("head_conv").alias("parent_conv"),
                "ids", "words", "n_convs", "conv_id", "ends",
            ),
            "moved",
        )
        used += 1
        made = moved.groupBy("container").agg(
            F.count("*").alias("posted"), F.min("conv_id").alias("head_conv"), F.sum("n_convs").alias("n_convs"),
            F.first("parent").alias("parent"), F.first("parent_conv").alias("parent_conv"),
            F.first(F.element_at("words", used)).alias("own_words"),
            F.max(F.when(F.size("ids") == used, F.col("ends"))).alias("ends"),
        )
        made = stored(made.withColumn("depth", F.lit(depth + used)), "heads")
        levels.append(made)
        heads = made.select("container", "posted", "head_conv")
        entries = moved.drop("parent", "parent_conv")


def _sums(parts: list[DataFrame]) -> DataFrame:
    """container, children, leaves and saved, summed."""
    whole = reduce(DataFrame.unionByName, parts)
    return whole.groupBy("container").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])


def prefix_trie(convs: DataFrame, turns: DataFrame, chunk: int = CHUNK, container: int = CONTAINER) -> DataFrame:
    """One row per node of the trie over conversations: see ``NODE`` for its columns.

    ``convs`` has each conv_id once; ``turns`` has conv_id, pos (0, 1, 2...), id and words.  conv_id is the smallest
    member of a node, n_convs its members, n_leaves the childless nodes of its subtree (itself included),
    saved_tokens the subtree's sum of (n_convs - 1) * words, ends_sha256 the digest of the ids of conversations that end
    there.  The root has depth 0, no parent and no words; without conversations there is no node.
    """
    spark = convs.sparkSession
    turn = F.struct("pos", "id", "words")
    chunks = turns.groupBy("conv_id", F.floor(F.col("pos") / chunk).cast("long").alias("chunk")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    chunks = stored(chunks.select("conv_id", "chunk", F.col("t.id").alias("ids"), F.col("t.words").alias("words")), "chunks")
    units = stored(units_of(convs, chunks), "units")
    whole = units.agg(F.min("conv_id"), F.sum("n_convs"), F.max(F.when(F.col("length") == 0, F.col("ends")))).first()
    if whole[0] is None:
        return spark.createDataFrame([], NODE)
    held = stored(chunks.join(units, "conv_id"), "unit-chunks")

    # downwards: the entries of one chunk after the other, and the units that are alone from some chunk on
    root = F.lit("")
    live = units.filter("length > 0").select("conv_id", root.alias("head"), F.lit(whole[0]).cast("long").alias("head_conv"))
    blocks, tails, b = [], [], 0
    while not live.isEmpty():
        rows = held.filter(F.col("chunk") == b).join(live, "conv_id")
        goes_on = F.col("length") > (b + 1) * chunk
        entries = rows.groupBy(F.col("head").alias("container"), "ids").agg(
            F.first("words").alias("words"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
            F.max(F.when(~goes_on, F.col("ends"))).alias("ends"), F.count(F.when(goes_on, 1)).alias("going_on"), F.first("head_conv").alias("head_conv"),
        )
        entries = stored(entries, "entries")
        heads = stored(entries.groupBy("container").agg(F.count("*").alias("posted"), F.first("head_conv").alias("head_conv")), "heads")
        blocks.append(_burst(entries.drop("head_conv", "going_on"), heads, b * chunk, container))
        ends = entries.filter("going_on > 0").select(_path(F.col("container"), F.col("ids")).alias("head"), F.col("conv_id").alias("head_conv"), F.col("going_on").alias("posted"))
        ends = stored(ends, "chunk-ends")
        moving = rows.filter(goes_on).select("conv_id", _path(F.col("head"), F.col("ids")).alias("head"))
        moving = stored(with_counted(moving, ends, "head", hot_from(units.count())), "moving")
        b += 1
        tails.append(moving.filter("posted = 1").withColumn("from_chunk", F.lit(b)).drop("posted"))
        live = moving.filter("posted > 1").drop("posted")

    nodes, below = [], None
    if tails:  # a chain: each chunk is a container of its own, with the sums of the later ones below it
        alone = held.join(reduce(DataFrame.unionByName, tails), "conv_id").filter(F.col("chunk") >= F.col("from_chunk"))
        own = (F.col("n_convs") - 1) * F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w)
        later = Window.partitionBy("conv_id").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
        more = ((F.col("chunk") + 1) * chunk < F.col("length")).cast("long")
        first = F.col("chunk") == F.col("from_chunk")
        chain = alone.select(
            F.when(first, F.col("head")).otherwise(F.concat(F.lit("chain "), F.col("conv_id").cast("string"), F.lit(" "), F.col("chunk").cast("string"))).alias("container"),
            F.when(first, F.col("head_conv")).otherwise(F.col("conv_id")).alias("head_conv"),
            (F.col("chunk") * chunk).alias("depth"), F.lit(0).alias("used"), "ids", "words", "n_convs", "conv_id",
            F.when(more == 0, F.col("ends")).alias("ends"), more.alias("children"), more.alias("leaves"),
            F.coalesce(F.sum(own).over(later), F.lit(0)).cast("long").alias("saved"),
        )
        chain = stored(swept(chain), "chains")
        nodes.append(chain.filter("container IS NULL").drop("container"))
        below = _tops(chain).filter("NOT startswith(container, 'chain ')")

    # upwards: what a container's head gets
    nothing = spark.createDataFrame([], "container string, children long, leaves long, saved long")
    below = nothing if below is None else below
    for small, levels in reversed(blocks):
        below = stored(_sums([below]), "below")
        entries = reduce(DataFrame.unionByName, small)
        ended = below.withColumnRenamed("container", "end")
        entries = entries.withColumn("end", F.when(F.size("ids") == chunk, _path(F.col("container"), F.expr("slice(ids, used + 1, size(ids))"))))
        filled = entries.join(ended, "end", "left").fillna(0, ["children", "leaves", "saved"])
        done = stored(swept(filled), "swept")
        nodes.append(done.filter("container IS NULL").drop("container"))
        found = _tops(done).unionByName(below)
        for made in reversed(levels):
            sums = _sums([found])
            full = made.join(sums, "container", "left").fillna(0, ["children", "leaves", "saved"])
            full = stored(
                full.select(
                    F.col("head_conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent_conv").alias("parent_conv_id"), "n_convs",
                    F.col("children").alias("n_children"), F.greatest("leaves", F.lit(1)).alias("n_leaves"),
                    (F.col("saved") + (F.col("n_convs") - 1) * F.col("own_words")).alias("saved_tokens"),
                    F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"), "parent",
                ),
                "burst",
            )
            nodes.append(full.drop("parent"))
            up = full.select(F.col("parent").alias("container"), F.lit(1).cast("long").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
            found = found.unionByName(up)
        below = found
    top = below.filter("container = ''").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("children", "leaves", "saved")])
    nodes.append(
        top.select(
            F.lit(whole[0]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
            F.lit(whole[1]).cast("long").alias("n_convs"), F.col("children").alias("n_children"), F.greatest("leaves", F.lit(1)).alias("n_leaves"),
            F.col("saved").alias("saved_tokens"), F.lit(whole[2] or NO_ENDS).alias("ends_sha256"),
        )
    )
    return reduce(DataFrame.unionByName, [n.select(*_NAMES) for n in nodes])


def _tops(done: DataFrame) -> DataFrame:
    """What ``swept`` passes to heads."""
    return done.filter("container IS NOT NULL").select(
        "container", F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")
    )


def conversation_trie(turns: DataFrame, heads: int = HEADS, family: int = FAMILY) -> DataFrame:
    """The prefix trie of ``turns`` (conv_id, turn, role, text) after the fold of ``rebuilt``.

    Turns go by turn, null first; equal ones by role and text.  A null role or text counts as empty, so repeated rows are
    repeated turns.  Rows without conv_id belong to no conversation and are left out.  Other columns are ignored.  An
    empty table has no nodes.
    """
    convs, rows = rebuilt(turns, heads, family)
    return prefix_trie(convs, rows)
