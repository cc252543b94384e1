"""Exact deduplication of texts by Grace hash partitioning.

Each scan task first merges its own equal texts, so a text copied a million times is exchanged once per task.  What is
left is dealt by content hash; each bucket goes through an open-addressing table that compares complete texts.  A
bucket that doesn't fit its memory is split by the next digits of the hash into spill files, and those again, until
each fits.  Spill files belong to one task attempt, only that attempt reads them, and they end with it: a lost executor
costs a repeated task.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import join_groups, stored, text_or_empty

#: Bytes of text a table may hold before its bucket is split, or, in a scan task, before it is passed on.
TABLE_BYTES = 64 << 20
#: Buckets a full table is split into: one hexadecimal digit of the hash.
FAN_OUT = 16

Record = tuple[bytes, bytes, int | None, int]  # digest, text, largest id, rows


class ContentTable:
    """Open addressing with linear probing over complete texts; keeps the largest id and the rows of each."""

    def __init__(self) -> None:
        self.slots: list[int] = [-1] * 64
        self.digests: list[bytes] = []
        self.texts: list[bytes] = []
        self.ids: list[int | None] = []
        self.rows: list[int] = []
        self.bytes = 0

    def __len__(self) -> int:
        return len(self.texts)

    def add(self, digest: bytes, text: bytes, doc: int | None, rows: int) -> None:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (entry := self.slots[at]) >= 0:
            if self.digests[entry] == digest and self.texts[entry] == text:
                self.rows[entry] += rows
                if doc is not None and (self.ids[entry] is None or doc > self.ids[entry]):
                    self.ids[entry] = doc
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.texts)
        self.digests.append(digest)
        self.texts.append(text)
        self.ids.append(doc)
        self.rows.append(rows)
        self.bytes += len(text) + 100
        if 2 * len(self.texts) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, digest in enumerate(self.digests):
            at = int.from_bytes(digest[-8:], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry

    def records(self) -> Iterator[Record]:
        return zip(self.digests, self.texts, self.ids, self.rows)


_HEAD = struct.Struct("<32sQ?qQ")


def _write(file, record: Record) -> None:
    digest, text, doc, rows = record
    file.write(_HEAD.pack(digest, len(text), doc is None, doc or 0, rows))
    file.write(text)


def _read(path: Path) -> Iterator[Record]:
    with path.open("rb") as file:
        while head := file.read(_HEAD.size):
            digest, length, unknown, doc, rows = _HEAD.unpack(head)
            yield digest, file.read(length), None if unknown else doc, rows


def _digit(digest: bytes, depth: int) -> int:
    byte = digest[depth // 2]
    return byte >> 4 if depth % 2 == 0 else byte & 15


def grace_groups(records: Iterable[Record], limit: int = TABLE_BYTES, depth: int = 0) -> Iterator[Record]:
    """One record per different text. A bucket over ``limit`` bytes goes to spill files by the hash digit at ``depth``."""
    held = ContentTable()
    records = iter(records)
    for record in records:
        held.add(*record)
        if held.bytes > limit and len(held) > 1 and depth < 2 * len(record[0]):
            break
    else:
        yield from held.records()
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        paths = [Path(folder, f"{digit:x}") for digit in range(FAN_OUT)]
        files = [path.open("wb") for path in paths]
        for source in (held.records(), records):
            for record in source:
                _write(files[_digit(record[0], depth)], record)
        del held
        for file in files:
            file.close()
        for path in paths:
            yield from grace_groups(_read(path), limit, depth + 1)
            path.unlink()


def _merged_in_scan(records: Iterable[Record], limit: int) -> Iterator[Record]:
    """Equal texts merged as far as memory goes; the exchange brings the rest together."""
    held = ContentTable()
    for record in records:
        held.add(*record)
        if held.bytes > limit:
            yield from held.records()
            held = ContentTable()
    yield from held.records()


def _batches(records: Iterator[Record], with_text: bool, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    names = ["digest", "text", "keep_id", "group_size"] if with_text else ["text_sha256", "keep_id", "group_size"]
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int64()] if with_text else [pa.string(), pa.int64(), pa.int64()]
    rows: list[tuple] = []
    size = 0
    schema = pa.schema(list(zip(names, types)))

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)

    for digest, text, doc, n in records:
        rows.append((digest, text, doc, n) if with_text else (digest.hex(), doc, n))
        size += len(text) + 100 if with_text else 100
        if size >= most:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def content_groups(docs: DataFrame, limit: int = TABLE_BYTES) -> DataFrame:
    """text_sha256, keep_id, group_size: one row per different text of ``docs`` (doc_id, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[Record]:
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    yield hashlib.sha256(text).digest(), text, doc, 1

        return _batches(_merged_in_scan(rows(), limit), with_text=True)

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[Record]:
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(4)))

        return _batches(grace_groups(rows(), limit), with_text=False)

    merged = docs.select(F.col("doc_id").cast("long"), text_or_empty("text").cast("binary").alias("text")).mapInArrow(
        scan, "digest binary, text binary, keep_id long, group_size long"
    )
    # not by the digest's first digits: those split a bucket
    dealt = merged.repartition(F.xxhash64("digest"))
    return dealt.mapInArrow(bucket, "text_sha256 string, keep_id long, group_size long")


def exact_dedup(docs: DataFrame, limit: int = TABLE_BYTES) -> DataFrame:
    """Which row of each group of equal texts stays.

    ``docs`` needs doc_id and text; other columns are ignored.  A null text equals the empty text.  The row with the
    largest doc_id stays, a null doc_id being the smallest; of rows with equal doc_id and text one stays.  Returns a
    row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.
    """
    groups = stored(content_groups(docs, limit), "text-groups")
    rows = (
        docs.select(F.col("doc_id").cast("long"), F.sha2(text_or_empty("text"), 256).alias("text_sha256"))
        .groupBy("doc_id", "text_sha256")
        .agg(F.count("*").alias("copies"))
        .select("doc_id", "text_sha256", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    )
    return join_groups(rows, groups, "text_sha256", "group_size", "doc_id").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, limit: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stay = exact_dedup(docs, limit).filter("kept").select(F.col("doc_id").alias("stay_id"), F.col("text_sha256").alias("stay_sha"))
    mark = "_sha256_of_text"
    once = docs.withColumn(mark, F.sha2(text_or_empty("text"), 256)).dropDuplicates(["doc_id", mark])
    return once.join(
        stay, once["doc_id"].cast("long").eqNullSafe(stay["stay_id"]) & (once[mark] == stay["stay_sha"]), "left_semi"
    ).drop(mark)
