"""Byte pair encoding and decoding without merging: dynamic programming over prefixes.

For every prefix of a pre-token exactly one token can be the last of its encoding.  A suffix automaton over the
vocabulary gives, at each byte, the tokens that end there; the one that is compatible with the last token of the prefix
before it is stored, and the stored tokens are followed back from the end.  Two neighbours are compatible when no merge
across their boundary comes before the merges that made them, which only the outer parts of both decide.  Ids equal
those of merging by rank.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_or_empty
from tillroll.llm.memory import Memory, groups_of

# fixed values: the split of texts before merging that vocabularies of this kind are made for
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space other than a space or a line feed.
RARE_SPACE = regex.compile(r"[^\S \n]")
NEVER = 1 << 40
#: Pairs of tokens whose test is remembered.
PAIRS = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class SuffixAutomaton:
    """All substrings of the tokens; each state knows the tokens that are suffixes of its strings, longest first."""

    def __init__(self, tokens: list[tuple[bytes, int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for token, _ in tokens:
            last = 0
            for byte in token:
                last = self._extend(last, byte)
        own: dict[int, list[tuple[int, int]]] = {}
        for token, number in tokens:
            state = 0
            for byte in token:
                state = self.next[state][byte]
            own.setdefault(state, []).append((len(token), number))
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.ends[self.link[state]]
            self.ends[state] = (*sorted(own[state], reverse=True), *above) if state in own else above

    def _extend(self, last: int, byte: int) -> int:
        following = self.next[last].get(byte)
        if following is not None:
            return following if self.length[following] == self.length[last] + 1 else self._clone(last, byte, following)
        state = self._state({}, self.length[last] + 1)
        at = last
        while at >= 0 and byte not in self.next[at]:
            self.next[at][byte] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            following = self.next[at][byte]
            exact = self.length[following] == self.length[at] + 1
            self.link[state] = following if exact else self._clone(at, byte, following)
        return state

    def _clone(self, at: int, byte: int, state: int) -> int:
        copy = self._state(dict(self.next[state]), self.length[at] + 1)
        self.link[copy] = self.link[state]
        self.link[state] = copy
        while at >= 0 and self.next[at].get(byte) == state:
            self.next[at][byte] = copy
            at = self.link[at]
        return copy

    def _state(self, following: dict[int, int], length: int) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1


class BytePairCodec:
    """Encodes and decodes whole texts with the vocabulary of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.spell = {i: bytes(map(letters.__getitem__, t)) for t, i in vocab.items() if t not in self.special}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # left, right, rank
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[left], vocab[right]
            self.rank.setdefault(pair, rank)
            self.parts.setdefault(vocab[left + right], (*pair, rank))
        sound: set[int] = set()
        for token in sorted(self.spell, key=lambda t: self.parts[t][2] if t in self.parts else -1):
            if token not in self.parts:
                if len(self.spell[token]) == 1:
                    sound.add(token)
            else:
                left, right, rank = self.parts[token]
                if left in sound and right in sound and not self._crossed(left, right, rank):
                    sound.add(token)
        self.automaton = SuffixAutomaton([(self.spell[t], t) for t in sorted(sound)])
        every = self.spell | {i: t.encode() for t, i in self.special.items()}
        self.sizes = np.zeros(max(every) + 1, np.int64)
        self.sizes[list(every)] = [len(s) for s in every.values()]
        self.starts = np.zeros_like(self.sizes)
        self.flat = np.frombuffer(b"".join(every.values()), np.uint8)
        self.starts[list(every)] = np.cumsum([0, *(len(s) for s in every.values())])[:-1]
        self.little = {t: t.to_bytes(4, "little") for t in every}
        self.decimal = [str(i) for i in range(max(every) + 1)]
        self.split = regex.compile(SPLIT)
        self.pairs: dict[int, bool] = {}
        self.pre_tokens = Memory(self._by_prefix)
        self.after_space = Memory(self._words)

    def _crossed(self, left: int, right: int, limit: int) -> bool:
        """Whether a merge across the boundary comes before ``limit`` and before both of its sides are merged away.

        Of equal merges the leftmost comes first: one that ends at the boundary wins over the crossing one, the
        crossing one over one that begins there.
        """
        gone = limit
        while True:
            other, until = right, limit
            while True:
                rank = self.rank.get((left, other), NEVER)
                if rank < gone and rank <= until and rank < limit:
                    return True
                if other not in self.parts:
                    break
                other, _, until = self.parts[other]
            if left not in self.parts:
                return False
            _, left, gone = self.parts[left]

    def _compatible(self, left: int, right: int) -> bool:
        pair = left << 20 | right
        if (known := self.pairs.get(pair)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = not self._crossed(left, right, NEVER)
        return known

    def _by_prefix(self, pre_tokens: list[str]) -> list[bytes]:
        """Ids of each pre-token. In order of their bytes, so that what a prefix stores serves all that begin with it."""
        automaton, little = self.automaton, self.little
        following, link, length, ends = automaton.next, automaton.link, automaton.length, automaton.ends
        order = sorted(range(len(pre_tokens)), key=(data := [t.encode() for t in pre_tokens]).__getitem__)
        out: list[bytes] = [b""] * len(pre_tokens)
        states, spans, last, sizes = [0], [0], [0], [0]  # of each prefix, the empty one first
        before = b""
        for number in order:
            text = data[number]
            at, least = 0, min(len(text), len(before))
            while at < least and text[at] == before[at]:
                at += 1
            del states[at + 1 :], spans[at + 1 :], last[at + 1 :], sizes[at + 1 :]
            state, matched = states[at], spans[at]
            for at in range(at, len(text)):
                byte = text[at]
                while byte not in following[state]:
                    state = link[state]
                    matched = length[state]
                state = following[state][byte]
                matched += 1
                for size, token in ends[state]:
                    if size <= matched and (size > at or self._compatible(last[at + 1 - size], token)):
                        break
                else:
                    raise ValueError(f"no token of the vocabulary can end at byte {at} of {text!r}")
                states.append(state)
                spans.append(matched)
                last.append(token)
                sizes.append(size)
            before = text
            at = len(text)
            ids = []
            while at:
                ids.append(little[last[at]])
                at -= sizes[at]
            ids.reverse()
            out[number] = b"".join(ids)
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that follow a space each; see _plain for what they are."""
        split = self.split.findall(" " + " ".join(words))
        lookup = self.pre_tokens.fill(set(split))
        ids: list[list[bytes]] = []
        for one in split:
            if one[0] == " ":
                ids.append([])
            ids[-1].append(lookup(one))
        return [b"".join(x) for x in ids]

    def _by_split(self, text: str) -> bytes:
        split = self.split.findall(text)
        return b"".join(map(self.pre_tokens.fill(set(split)), split))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes; special tokens' strings give their ids."""
        words: list[list[str] | None] = []
        for text in texts:
            # where every space follows another character and opens a pre-token, words can be encoded apart
            odd = "  " in text or "\n " in text or RARE_SPACE.search(text) or any([s in text for s in self.special])
            words.append(None if odd else text.split(" "))
        lookup = self.after_space.fill(set().union(*[w[1:] for w in words if w]))
        out = []
        for text, own in zip(texts, words):
            if own is None:
                parts = regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text) if self.special else [text]
                out.append(b"".join([self.little[self.special[p]] if p in self.special else self._by_split(p) for p in parts]))
            else:
                out.append(self._by_split(own[0]) + b"".join(map(lookup, own[1:])))
        return out

    def written(self, ids: bytes) -> str:
        """Decimal ids with commas between."""
        return ",".join(map(self.decimal.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids in little-endian 32-bit bytes stand for, special tokens with their strings."""
        numbers = np.frombuffer(ids, "<u4")
        if not len(numbers):
            return b""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1]) + np.repeat(self.starts[numbers] - ends + sizes, sizes)].tobytes()


_codecs: dict[str, BytePairCodec] = {}


def codec(path: str) -> BytePairCodec:
    """The codec of a file, made once in each process."""
    if path not in _codecs:
        _codecs[path] = BytePairCodec(path)
    return _codecs[path]


def round_trip(docs: DataFrame, tokenizer: str, outputs: bool = False) -> DataFrame:
    """Encodes every whole text, decodes the ids, and returns the digests of both.

    ``docs`` needs doc_id and text; other columns are ignored.  Null counts as the empty text, which has no ids.
    Repeated rows and null doc_ids give a row each.  ``tokenizer`` is a byte-level file of which every worker has a
    copy.  Returns doc_id, n_tokens, ids_sha256 (of decimal ids with commas), decoded_sha256, and with ``outputs`` also
    ids (array) and decoded (text).  Texts are worked on where they are read, without an exchange.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if outputs:
        names, types, schema = [*names, "ids", "decoded"], [*types, pa.list_(pa.int32()), pa.string()], schema + ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            for group in groups_of(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                rows = []
                for (doc, _), ids in zip(group, own.encode_many([text for _, text in group])):
                    decoded = own.decode(ids).decode("utf-8", "replace")
                    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (own.written(ids), decoded)]
                    row = doc, len(ids) // 4, *digests
                    rows.append((*row, np.frombuffer(ids, "<i4"), decoded) if outputs else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).mapInArrow(run, schema)
