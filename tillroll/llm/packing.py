"""Packing of documents into training sequences of several lengths.

A scan task packs what it reads, so nothing is exchanged and no key can be hot.  Each document is encoded and closed
with the end id.  Its full windows of the longest tier are sequences of their own.  The rest goes to the shortest tier
that holds it.  When enough rests wait, each tier is packed, longest first: a rest opens a window of its tier and
shorter rests fill the gap, the largest that fits first; a last gap is closed by cutting a piece.  What is left at the
end of a task becomes windows of shorter tiers, and one padded window at most.  Sequences of a tier are dealt to step
groups of equal tokens.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_or_empty
from tillroll.llm.memory import Memory, groups_of

WINDOW = 2048
#: Lengths of sequences that need no padding, each a power of two; shorter rests are padded to the longest.
TIERS = (256, 512, 1024, 2048)
END_ID = 1
#: Rests that wait in a task before they are packed together.
WAITING = 4096
#: Bytes of remembered words in a process, half of what it may hold; words that are encoded as one text, and such texts at a time.
WORD_BYTES = 60_000_000
JOINED_WORDS = 128
JOINED_TEXTS = 16
#: Normalization that does nothing to words in NFC but lower-case them.
ONLY_LOWERS = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
#: Tokens of a step group.
STEP_TOKENS = 64 * WINDOW
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier long, step_group long"
)


class WordEncoder:
    """Ids of whole texts by the tokenizer, as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins across it, so ids of a text are those of its words in turn, and
    frequent words are remembered.  A text where that doesn't hold as it stands (special tokens, a form that
    normalization changes, a final sigma, control characters) goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = Memory(self._encoded_words, most=1 << 62, most_bytes=WORD_BYTES)
        # a special token ends the word before it and starts the next, so many words are encoded as one text
        self.between = next((t for t in self.special if self._separates(t)), None)
        self.between_id = None if self.between is None else self.tokenizer.token_to_id(self.between)
        self.of_words = self.tokenizer
        if json.loads(Path(path).read_text(encoding="utf-8")).get("normalizer") == ONLY_LOWERS:
            self.of_words = Tokenizer.from_file(path)
            self.of_words.no_truncation()
            self.of_words.no_padding()
            self.of_words.normalizer = normalizers.Lowercase()

    def _separates(self, token: str) -> bool:
        """Whether words joined by ``token`` get the ids that they get alone, with the token's id between them."""
        trial = ["a", "the", "123", "é", "x-y", "...", "漢字", "a"]
        joined = self.tokenizer.encode(token.join(trial), add_special_tokens=False).ids
        alone = [one.ids for one in self.tokenizer.encode_batch_fast(trial, add_special_tokens=False)]
        return joined == [i for n, ids in enumerate(alone) for i in ([self.tokenizer.token_to_id(token)] if n else []) + ids]

    def _encoded(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 1000):
            for one in self.tokenizer.encode_batch_fast(texts[at : at + 1000], add_special_tokens=False):
                yield array("I", one.ids).tobytes()

    def _encoded_words(self, words: list[str]) -> Iterator[bytes]:
        if self.between is None:
            yield from self._encoded(words)
            return
        step = JOINED_WORDS * JOINED_TEXTS
        for first in range(0, len(words), step):
            parts = [words[at : at + JOINED_WORDS] for at in range(first, min(first + step, len(words)), JOINED_WORDS)]
            joined = self.of_words.encode_batch_fast([self.between.join(some) for some in parts], add_special_tokens=False)
            for some, one in zip(parts, joined):
                ids = np.array(one.ids, "<u4")
                cuts = np.flatnonzero(ids == self.between_id)
                assert len(cuts) == len(some) - 1, "a word holds the token between words"
                data, start = ids.tobytes(), 0
                for cut in (4 * cuts).tolist():
                    yield data[start:cut]
                    start = cut + 4
                yield data[start:]

    def _plain(self, text: str) -> bool:
        return (
            not any([token in text for token in self.special])
            and "Σ" not in text
            and not any([c in text for c in "\x1c\x1d\x1e\x1f"])
            and unicodedata.is_normalized("NFC", text)
        )

    def __call__(self, texts: list[str]) -> list[bytes]:
        lowered = [text.lower() if self._plain(text) else None for text in texts]
        # a text may leave NFC when it is lower-cased
        words = [text.split() if text is not None and unicodedata.is_normalized("NFC", text) else None for text in lowered]
        lookup = self.words.fill(set().union(*[w for w in words if w]))
        return [
            next(self._encoded([text])) if own is None else b"".join(map(lookup, own)) for text, own in zip(texts, words)
        ]


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The encoder of a file, made once in each process; what it remembers serves the process's next tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class Packer:
    """Pieces of documents placed in sequences, in the order in which they come.

    A piece is (doc_id, start, ids as bytes, tokens of the document).
    """

    def __init__(self, first_sequence: int, tiers=TIERS, waiting: int = WAITING, step_tokens: int = STEP_TOKENS):
        self.tiers, self.most, self.step_tokens = sorted(tiers), waiting, step_tokens
        self.window = self.tiers[-1]
        self.next, self.first = first_sequence, first_sequence
        self.rests: list[list[tuple]] = [[] for _ in self.tiers]  # by tier: (tokens, arrival, piece), ascending
        self.n = self.arrivals = 0
        self.made = dict.fromkeys(self.tiers, 0)

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        tokens = len(ids) // 4
        full = tokens - tokens % self.window
        for start in range(0, full, self.window):
            yield from self._close([(doc, start, ids[4 * start : 4 * (start + self.window)], tokens)])
        if full < tokens:
            self._wait((doc, full, ids[4 * full :], tokens))
            if self.n >= self.most:
                yield from self._pack()

    def finish(self) -> Iterator[tuple]:
        yield from self._pack()
        left = [rest[2] for tier in reversed(self.rests) for rest in reversed(tier)]
        self.rests, self.n = [[] for _ in self.tiers], 0
        while (tokens := sum(len(p[2]) // 4 for p in left)) > 0:
            size = next((t for t in reversed(self.tiers) if t <= tokens), tokens)
            window: list[tuple] = []
            while size:
                piece, rest = self._cut(left.pop(0), size)
                window.append(piece)
                size -= len(piece[2]) // 4
                if rest:
                    left.insert(0, rest)
            yield from self._close(window)

    def _wait(self, piece: tuple) -> None:
        tokens = len(piece[2]) // 4
        tier = next(i for i, t in enumerate(self.tiers) if tokens <= t)
        self.arrivals += 1
        insort(self.rests[tier], (tokens, self.arrivals, piece))
        self.n += 1

    def _fit(self, gap: int) -> tuple | None:
        """The largest waiting rest of at most ``gap`` tokens."""
        for tier in reversed(self.rests):
            at = bisect_right(tier, (gap, float("inf")))
            if at:
                self.n -= 1
                return tier.pop(at - 1)[2]
        return None

    @staticmethod
    def _cut(piece: tuple, size: int) -> tuple[tuple, tuple | None]:
        doc, start, ids, tokens = piece
        if len(ids) <= 4 * size:
            return piece, None
        return (doc, start, ids[: 4 * size], tokens), (doc, start + size, ids[4 * size :], tokens)

    def _pack(self) -> Iterator[tuple]:
        """Full windows from what waits; stops when the rest doesn't fill the window of its longest piece."""
        waiting = sum(r[0] for tier in self.rests for r in tier)
        while self.n:
            top = max(i for i, tier in enumerate(self.rests) if tier)
            size = self.tiers[top]
            if waiting < size:
                return
            waiting -= size
            window, gap = [], size
            while gap:
                piece = self._fit(gap)
                if piece is None:  # all that wait are longer than the gap: cut the shortest
                    tier = next(t for t in self.rests if t)
                    piece, rest = self._cut(tier.pop(0)[2], gap)
                    self.n -= 1
                    self._wait(rest)
                window.append(piece)
                gap -= len(piece[2]) // 4
            yield from self._close(window)

    def _close(self, window: list[tuple]) -> Iterator[tuple]:
        size = sum(len(p[2]) // 4 for p in window)
        tier = size if size in self.made else self.window
        group = self.first + self.tiers.index(tier) * (1 << 36) + self.made[tier] * tier // self.step_tokens
        self.made[tier] += 1
        offset = 0
        for doc, start, ids, tokens in window:
            length = len(ids) // 4
            yield doc, start, length, zlib.crc32(ids), tokens, self.next, offset, tier, group
            offset += length
        self.next += 1


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, tiers=TIERS, waiting: int = WAITING) -> DataFrame:
    """Pieces of all documents with their place in a sequence; see the module for the method.

    ``docs`` needs doc_id and text; other columns are ignored.  A null text counts as empty and gives the end id alone.
    A null doc_id and repeated rows are packed like others.  ``tokenizer`` is the file of a tokenizer of which every
    worker has a copy.  Sequences fill a tier exactly, but for one of each task.  sequence_id carries the task's number
    in its upper bits; step_group is unique in the same way.
    """
    tiers, waiting = tuple(tiers), int(waiting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, closing = word_encoder(tokenizer), end_id.to_bytes(4, "little")
        packer = Packer(TaskContext.get().partitionId() << 40, tiers, waiting)
        names = [f.split()[0] for f in SCHEMA.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

        for one in batches:
            for group in groups_of(zip(one.column(0).to_pylist(), one.column(1).to_pylist())):
                rows: list[tuple] = []
                for (doc, _), ids in zip(group, encode([text for _, text in group])):
                    rows += packer.add(doc, ids + closing)
                if rows:
                    yield batch(rows)
        if rows := list(packer.finish()):
            yield batch(rows)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).mapInArrow(run, SCHEMA)
