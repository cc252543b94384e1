"""Toxicity scores by a factorization machine over hashed terms.

A text is the set of its terms: words and the first letters of longer words, hashed to a fixed number of buckets.  The
score is the logistic of a bias, a weight per term and, for each pair of terms, the product of their factors, which
lets a pair count that neither term does alone.  The machine is learnt by one task from a bounded, hash-drawn sample of
labelled texts, in two parts: first the terms whose own labels stand out, then all terms that a few texts hold, on what
the first part leaves open.  The second part is where pairs of terms that are neutral alone are found; it stops, or stays
empty, when texts that were kept out gain no more.  Every text of the table is then scored where it is read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_or_empty
from tillroll.llm.memory import Memory, groups_of

#: Buckets of hashed terms.
BUCKETS = 1 << 18
FACTORS = 4
#: Labelled texts to learn from, at most.
SAMPLE = 12_000
#: Passes over the sample.
EPOCHS = 12
THRESHOLD = 0.7
#: Lengths of the beginnings of words that are terms of their own.
STEMS = (4, 5, 6)
#: A term belongs to the first part if its texts' labels differ from the others' by so much (likelihood ratio statistic).
EVIDENCE = 16.0
#: Texts of the sample that must hold a term of the second part, which has no other screen.
LEAST_TEXTS = 5
#: Share of the sample that is kept out to tell when to stop, and passes without a gain that end the learning.
VALIDATION, PATIENCE = 0.1, 2

WORD = re.compile(r"[^\W\d_]+")


def buckets_of(words: list[str], buckets: int) -> list[np.ndarray]:
    """The buckets of each word's terms."""
    out = []
    for word in words:
        terms = [f"={word}", *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]
        out.append(np.array([zlib.crc32(t.encode("utf-8", "replace")) % buckets for t in terms], np.int64))
    return out


class TermReader:
    """Terms of whole texts as sorted distinct buckets; words are remembered."""

    def __init__(self, buckets: int):
        self.words = Memory(self._of_parts)
        self.buckets = buckets

    def _of_parts(self, parts: list[str]) -> list[bytes]:
        found = [WORD.findall(part) for part in parts]
        flat = buckets_of([w for words in found for w in words], self.buckets)
        out, at = [], 0
        for words in found:
            out.append(b"".join([x.tobytes() for x in flat[at : at + len(words)]]))
            at += len(words)
        return out

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        parts = [set(text.lower().split()) for text in texts]
        lookup = self.words.fill(set().union(*parts))
        return [np.unique(np.frombuffer(b"".join(map(lookup, own)), np.int64)) for own in parts]


def likelihood_ratio(texts: np.ndarray, positive: np.ndarray, all_texts: float, all_positive: float) -> np.ndarray:
    """How much better the labels of the texts with a term are told by a rate of their own (G statistic)."""
    share = np.clip(all_positive / max(1, all_texts), 1e-9, 1 - 1e-9)
    out = np.zeros(len(texts))
    for inside, outside, p in ((positive, all_positive - positive, share), (texts - positive, all_texts - texts - all_positive + positive, 1 - share)):
        for seen, expected in ((inside, texts * p), (outside, (all_texts - texts) * p)):
            ratio = np.divide(seen, expected, out=np.ones(len(texts)), where=(seen > 0) & (expected > 0))
            out += 2 * seen * np.log(ratio)
    return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Part:
    """A bias, and weights and factors of some terms; rows are places among the terms."""

    def __init__(self, bias: float, terms: np.ndarray, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.terms, self.weights, self.factors = bias, terms, weights, factors

    def rows(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """The places of each text's terms; terms that the part doesn't know are left out."""
        if not len(self.terms):
            return [np.zeros(0, np.int32)] * len(texts)
        out = []
        for x in texts:
            place = np.minimum(np.searchsorted(self.terms, x), len(self.terms) - 1).astype(np.int32)
            out.append(place[self.terms[place] == x])
        return out

    def sums(self, rows: list[np.ndarray]) -> np.ndarray:
        """Bias, weights and products of all pairs, before the logistic."""
        out = np.empty(len(rows))
        for at, x in enumerate(rows):
            own = self.factors[x] / np.sqrt(max(1, len(x)))  # pairs of long texts would drown the terms
            total = own.sum(0)
            out[at] = self.bias + self.weights[x].sum() + 0.5 * (total * total - (own * own).sum(0)).sum()
        return out

    def learn(self, rows: list[np.ndarray], labels: np.ndarray, known: np.ndarray, random: np.random.Generator, rate: float, shrink: float) -> None:
        """One AdaGrad pass over the rows on the logistic loss; ``known`` is added to each row's sum."""
        w, v = self.weights, self.factors
        if not hasattr(self, "steps"):
            self.steps = [np.full(len(w), 1e-6), np.full(v.shape, 1e-6), 1e-6]
        gw, gv, gb = self.steps
        for at in random.permutation(len(rows)):
            x = rows[at]
            scale = 1 / np.sqrt(max(1, len(x)))
            own = v[x] * scale
            total = own.sum(0)
            score = known[at] + self.bias + w[x].sum() + 0.5 * float((total * total - (own * own).sum(0)).sum())
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[at]
            if abs(error) < 1e-3:
                continue
            d = error + shrink * w[x]
            gw[x] += d * d
            w[x] -= rate * d / np.sqrt(gw[x])
            d = error * scale * (total - own) + shrink * v[x]
            gv[x] += d * d
            v[x] -= rate * d / np.sqrt(gv[x])
            gb += error * error
            self.bias -= rate * error / np.sqrt(gb)
        self.steps[2] = gb


class FactorizationMachine:
    """Binary factorization machine on sets of bucket numbers: the sum of its parts."""

    def __init__(self, parts: list[Part]):
        self.parts = parts

    @staticmethod
    def fit(
        texts: list[np.ndarray], labels: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS,
        evidence: float = EVIDENCE, least_texts: int = LEAST_TEXTS, seed: int = 7,
    ) -> "FactorizationMachine":
        counts = np.zeros(1 + max((int(t[-1]) for t in texts if len(t)), default=0))
        positive = np.zeros(len(counts))
        for text, label in zip(texts, labels):  # a text's terms are distinct
            counts[text] += 1
            positive[text] += label
        terms = np.flatnonzero(counts)
        counts, positive = counts[terms], positive[terms]
        stand_out = likelihood_ratio(counts, positive, len(texts), labels.sum()) >= evidence
        random = np.random.default_rng(seed)
        bias = 0.0
        if len(labels) and 0 < labels.mean() < 1:
            bias = float(np.log(labels.mean() / (1 - labels.mean())))
        first, second = (
            Part(b, own, np.zeros(len(own)), random.normal(0, spread, (len(own), factors)))
            for b, own, spread in ((bias, terms[stand_out], 0.01), (0.0, terms[counts >= least_texts], 0.1))
        )
        rows = first.rows(texts)
        for _ in range(epochs):
            first.learn(rows, labels, np.zeros(len(rows)), random, 0.2, 1e-4)
        order = random.permutation(len(texts))
        kept_out = order[: int(VALIDATION * len(order))]
        if not len(kept_out):
            return FactorizationMachine([first])
        # what the first part leaves open, told by a first part that hasn't seen the texts
        learnt = order[len(kept_out) :]
        blind = Part(bias, first.terms, np.zeros(len(first.terms)), random.normal(0, 0.01, first.factors.shape))
        for _ in range(epochs):
            blind.learn([rows[i] for i in learnt], labels[learnt], np.zeros(len(learnt)), random, 0.2, 1e-4)
        known = blind.sums(rows)
        rows = second.rows(texts)

        def loss(extra: np.ndarray) -> float:
            told = np.clip(logistic(known[kept_out] + extra), 1e-6, 1 - 1e-6)
            return -float(np.mean(labels[kept_out] * np.log(told) + (1 - labels[kept_out]) * np.log(1 - told)))

        best, chosen, waited = loss(np.zeros(len(kept_out))), None, 0
        for _ in range(epochs):
            second.learn([rows[i] for i in learnt], labels[learnt], known[learnt], random, 0.1, 2e-3)
            now = loss(second.sums([rows[i] for i in kept_out]))
            if now < 0.95 * best:
                best, waited = now, 0
                chosen = Part(second.bias, second.terms, second.weights.copy(), second.factors.copy())
            elif (waited := waited + 1) > PATIENCE:
                break
        return FactorizationMachine([first] if chosen is None else [blind, chosen])

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Scores of texts given as sorted bucket numbers."""
        return logistic(sum((part.sums(part.rows(texts)) for part in self.parts), np.zeros(len(texts))))


def learn_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text, label: at most ``sample`` labelled rows whose crc32(doc_id) mod 3 isn't 1, in order of a hash of doc_id."""
    known = (
        labels.filter("toxic is not null and doc_id is not null and crc32(cast(doc_id as string)) % 3 != 1")
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.max("toxic").cast("int").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(sample)
    )
    # at most ``sample`` narrow rows, whatever the input
    return docs.join(F.broadcast(known), docs["doc_id"].cast("long") == known["label_id"]).select(
        "label_id", text_or_empty("text").alias("text"), "label"
    )


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS, **options
) -> FactorizationMachine:
    """A machine from the sample, learnt in one task; its size is bounded by ``buckets``.

    Terms are read by all tasks, so the learning task gets at most ``sample`` lists of distinct buckets.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = TermReader(buckets)
        for batch in batches:
            rows = zip(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()), batch.column(1).to_pylist())
            for group in groups_of(rows):
                terms = reader([text for _, text in group])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for (i, _), _ in group], pa.int64()),
                        pa.array([y for (_, y), _ in group], pa.int32()),
                        pa.array([t.astype("<i4").tobytes() for t in terms], pa.binary()),
                    ],
                    names=["id", "label", "terms"],
                )

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        machine = FactorizationMachine.fit(
            [np.frombuffer(t, "<i4") for t in rows["terms"]], rows["label"].to_numpy(float), **options
        )
        useful = [np.flatnonzero(part.weights) for part in machine.parts]
        arrays = {"terms": "<i8", "weights": "<f8", "factors": "<f8"}
        packed = {n: [getattr(p, n)[u].astype(t).tobytes() for p, u in zip(machine.parts, useful)] for n, t in arrays.items()}
        return pd.DataFrame({"part": range(len(useful)), "bias": [p.bias for p in machine.parts], **packed})

    terms = learn_rows(docs, labels, sample).mapInArrow(read, "id long, label int, terms binary").withColumn("all", F.lit(0))
    fitted = terms.groupBy("all").applyInPandas(learn, "part int, bias double, terms binary, weights binary, factors binary").collect()
    parts = []  # none without labelled rows: no evidence either way
    for row in sorted(fitted, key=lambda r: r["part"]):  # two at most
        weights = np.frombuffer(row["weights"], "<f8")
        factors = np.frombuffer(row["factors"], "<f8").reshape(len(weights), -1) if len(weights) else np.zeros((0, 1))
        parts.append(Part(row["bias"], np.frombuffer(row["terms"], "<i8"), weights, factors))
    return FactorizationMachine(parts)


def score_toxicity(docs: DataFrame, machine: FactorizationMachine, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by the buckets
    names, types = ["doc_id", "score"], [pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, own = TermReader(buckets), sent.value
        for batch in batches:
            for group in groups_of(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                scores = own.scores(reader([text for _, text in group]))
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in group], types[0]), pa.array(scores, types[1])], names=names)

    scored = docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).mapInArrow(run, "doc_id long, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Learns from the labelled rows that are not held out, and scores all of ``docs``.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns are ignored.  A null text counts as
    empty and gets the score of no terms.  Labels of one doc_id that disagree count as toxic; null ones are left out.
    Without any labels all scores are 0.5.  Repeated rows get the same score.
    """
    return score_toxicity(docs, fit_toxicity(docs, labels, sample), threshold=threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns, scored where they are read."""
    machine = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, sample))

    @F.pandas_udf("boolean")
    def stays(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader, own = TermReader(BUCKETS), machine.value
        for batch in texts:
            rows = ((None, text) for text in batch)
            yield pd.Series(np.concatenate([own.scores(reader([t for _, t in g])) for g in groups_of(rows)] or [np.zeros(0)]) < threshold)

    return docs.filter(stays(text_or_empty("text")))
