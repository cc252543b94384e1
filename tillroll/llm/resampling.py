"""Importance resampling of documents towards a target set, by hashed n-grams.

Separators are collapsed to single spaces, so the runs of 1 to MOST consecutive words that start at a word are spans of
that text: an overlapped scan, with lookarounds at both ends, finds them for every word, and the CRC of a span's bytes
names its bucket.  The gain of a bucket is how much more frequent it is in the target than in the documents; a
document's weight is the sum over its n-grams.  A score adds Gumbel noise that depends on the doc_id only, so that the
highest scores are a draw without replacement in proportion to exp(weight / 1000), the same on every run.

Documents are scanned once: their bucket counts are stored and read by the sums over all documents and by the weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import numbered, stored
from tillroll.llm.memory import groups_of

BUCKETS = 10_000
MOST = 3
#: Documents with fewer words can't be drawn; PERCENT of the others are.
LEAST_WORDS = 20
PERCENT = 5
#: n-grams of a text that are counted together.
BLOCK = 1 << 18

_WORD = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
#: A-Z become lower case, bytes outside words become spaces; other letters are left as they are.
_TO_WORDS = bytes(b if b in _WORD else 32 for b in bytes(range(256)).lower())
_GAPS = regex.compile(rb" {2,}")
#: The span of up to MOST words from a word's start, each word a group.
_RUNS = regex.compile(rb"(?<![^ ])([^ ]++)(?: ([^ ]++)(?: ([^ ]++))?)?(?![^ ])")


def words_of(text: bytes) -> bytes:
    """The words of a UTF-8 text with single spaces between them."""
    return _GAPS.sub(b" ", text.translate(_TO_WORDS)).strip(b" ")


def gram_codes(words: bytes) -> Iterator[list[int]]:
    """The CRCs of all runs of 1 to MOST words, in lists of about BLOCK."""
    crc, found = zlib.crc32, []
    add = found.append
    for match in _RUNS.finditer(words, overlapped=True):
        one, two, three = match.groups()
        code = crc(one)
        add(code)
        if two is not None:  # the CRC is carried on over the rest of the span
            code = crc(two, crc(b" ", code))
            add(code)
            if three is not None:
                add(crc(three, crc(b" ", code)))
        if len(found) >= BLOCK:
            yield found
            found = []
            add = found.append
    yield found


def bucket_counts(words: bytes, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that a text's n-grams fall in, and how many fall in each."""
    total = None
    for codes in gram_codes(words):
        own = np.array(codes, np.uint32) % np.uint32(buckets)
        if total is None and len(codes) < buckets:  # a short text, the only block
            return np.unique(own, return_counts=True)
        total = np.bincount(own, minlength=buckets) + (0 if total is None else total)
    found = np.flatnonzero(total)
    return found, total[found]


def packed(found: np.ndarray, counts: np.ndarray) -> bytes:
    """Pairs (bucket, count) of two unsigned 16-bit numbers; a larger count takes several pairs."""
    most = 0xFFFF
    if len(counts) and counts.max() > most:
        times = -(-counts // most)
        last = np.cumsum(times) - 1
        found, pieces = np.repeat(found, times), np.full(times.sum(), most)
        pieces[last] = counts - (times - 1) * most
        counts = pieces
    return np.stack([found, counts], 1).astype("<u2").tobytes()


def unpacked(grams: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and counts of many rows, and where each row ends in them."""
    pairs = np.frombuffer(b"".join(grams.to_pylist()), "<u2").reshape(-1, 2).astype(np.int64)
    return pairs[:, 0], pairs[:, 1], np.cumsum(pc.binary_length(grams).to_numpy()) // 4


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches: numbers take several times the bytes of their packed form."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def counted(docs: DataFrame, id_column: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words and grams (``packed`` bucket counts) of every row; at most 65,536 buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ((doc, text or b"") for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for group in groups_of(rows):
                words = [words_of(text) for _, text in group]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc for doc, _ in group], pa.int64()),
                        pa.array([w.count(b" ") + 1 if w else 0 for w in words], pa.int64()),
                        pa.array([packed(*bucket_counts(w, buckets)) for w in words], pa.binary()),
                    ],
                    names=["doc_id", "n_words", "grams"],
                )

    small = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return small.mapInArrow(run, "doc_id long, n_words long, grams binary")


def bucket_sums(grams: DataFrame, buckets: int = BUCKETS) -> dict[int, int]:
    """n-grams by bucket over all rows; at most ``buckets`` numbers leave a task or reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in sliced(batches):
            found, counts, _ = unpacked(batch.column(0))
            total += np.bincount(found, counts, buckets).astype(np.int64)  # exact below 2**53
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], names=["bucket", "n"])

    in_tasks = grams.select("grams").mapInArrow(run, "bucket long, n long")
    return {r["bucket"]: r["n"] for r in in_tasks.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, in thousandths of a natural logarithm."""
    all_source, all_target = float(sum(source.values())), float(sum(target.values()))
    return np.array(
        [
            math.floor(1000 * math.log((target.get(b, 0) + 1.0) * (all_source + buckets) / ((source.get(b, 0) + 1.0) * (all_target + buckets))))
            for b in range(buckets)
        ],
        np.int64,
    )


def noise(doc_id: Column) -> Column:
    """Gumbel noise in thousandths, from the doc_id alone."""
    digest = F.sha2(F.concat(F.lit("42:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``; drawn rows have a rank, 1 for the first.

    ``docs`` needs doc_id and text, ``target`` text; other columns are ignored.  A null text has no words, so weight 0,
    and is never drawn; so has an empty one.  A null doc_id takes part with the noise of an empty number and loses ties.
    Repeated rows are scored, ranked and counted each.  Without target texts the gains favour rare buckets; without
    documents the result is empty.
    """
    grams = stored(counted(docs, buckets=buckets), "grams")
    wanted = counted(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets=buckets)
    gain = gains(bucket_sums(grams, buckets), bucket_sums(wanted, buckets), buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found, counts, ends = unpacked(batch.column(2))
            n_features, weight = (
                np.diff(np.concatenate(([0], np.cumsum(part)))[ends], prepend=0) for part in (counts, counts * gain[found])
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_features), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    weighed = grams.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    scored = stored(
        weighed.select(
            "doc_id", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"))).alias("score"),
            (F.col("n_words") >= least_words).alias("eligible"),
        ),
        "scores",
    )
    drawn = scored.filter("eligible").count() * percent // 100
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).cast("long")
    return numbered(scored, order, "place").select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns, in no order.

    A doc_id that several rows share is drawn with all its rows when one of them is.
    """
    chosen = resample(docs, target, percent).filter("rank IS NOT NULL").select(F.col("doc_id").alias("drawn_id")).distinct()
    return docs.join(chosen, docs["doc_id"].cast("long").eqNullSafe(chosen["drawn_id"]), "left_semi")
