"""Secrets in texts: fixed patterns, and strings that a battery of tests can't tell from random ones.

A long string is read in the smallest encoding that holds its characters and gets p values of three tests of
randomness: chi-squared for a uniform alphabet, runs about the alphabet's middle, and serial correlation.  Fisher's
method combines them.  Short strings pass such tests easily, so the result is held against decoys, the corpus's most
frequent words and numbers joined in the same encoding and range of lengths: the share of decoys that look as random is
the string's p value.  Beyond the most random decoys it follows a tail fitted to them, a power of the distance to the
largest value there is (Hill's estimate), so the number of decoys is no lower bound.  Benjamini and Hochberg's rule on the p values, rounded up to steps, controls
false discoveries in each range of lengths.
"""

from __future__ import annotations

import bisect
import math
import random
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored, text_or_empty

# fixed values: kinds in the order of reports, and what the fixed ones match
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: What a text with an assignment holds in lower case.
NAMES = ("password", "passwd", "secret", "token", "api")
LONG = re.compile(r"\S{20,}")
#: Strings the battery tests.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Encodings from the smallest alphabet to the largest.
ENCODINGS = [
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("upper hex", "0123456789ABCDEF"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower and digits", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("upper and digits", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("letters and digits", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("any", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
]
PLACES = [{c: i for i, c in enumerate(alphabet)} for _, alphabet in ENCODINGS]
#: Lengths at which a new range begins.
LENGTHS = (20, 24, 32, 48, 96)
#: Steps of the p value, finer where most strings lie, and the first one that may ever be reported (a p value of 1/32).
CHANCES = [2.0**-n for n in (*range(15), 17, 21, 28, 40, 64)]
STEPS, FIRST = len(CHANCES), 5
#: Least combined p value of the tests of randomness of what is reported.
FLOOR = 0.001
#: Decoys of one encoding and range of lengths, and the most random ones among them that the tail is fitted to.
DECOYS, TAIL = 3_000, 100
#: Least distance that counts, in logarithms of the combined p value.
NARROW = 1e-9
#: Decoys are joined from so many frequent words at most, of which each comes so many times in the corpus at least.
FREQUENT, TIMES = 1_000, 5
# fixed values: what decoys are joined from where the corpus has fewer words, and words in hexadecimal digits
WORDS = """the and that with this from have which their about would there were other people time only into first after
also over under information service user name file data test value index page image video content default system config
und der die das nicht eine werden auch sich wurde les des dans pour qui une avec sont plus los las una por para como
este entre sobre""".split()
HEX_WORDS = "face cafe decade facade added feed deed beef dead fade bead cab dab fed ace bad bed".split()
#: Share of false discoveries.
SHARE = 0.05


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared_tail(x: float, freedom: int) -> float:
    """Wilson and Hilferty's normal approximation of the upper tail."""
    spread = 2 / (9 * freedom)
    return 0.5 * math.erfc(((x / freedom) ** (1 / 3) - (1 - spread)) / math.sqrt(2 * spread))


def encoding(text: str) -> int:
    return next(i for i, p in enumerate(PLACES) if all([c in p for c in text]))


def randomness(text: str, code: int | None = None) -> float:
    """Combined p value of the three tests that ``text`` is random in its encoding, or the given one."""
    text = text.rstrip("=")
    places = PLACES[encoding(text) if code is None else code]
    values, n, k = [places[c] for c in text], len(text), len(places)
    counts = dict.fromkeys(values, 0)
    for v in values:
        counts[v] += 1
    uniform = chi_squared_tail(sum(c * c for c in counts.values()) * k / n - n, k - 1)
    high = [2 * v >= k for v in values]
    above = sum(high)
    below = n - above
    if above and below:
        changes = 1 + sum(a != b for a, b in zip(high, high[1:]))
        mean = 1 + 2 * above * below / n
        runs = two_sided((changes - mean) / math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1))))
    else:
        runs = 2.0 ** (1 - n)
    middle = sum(values) / n
    square = sum((v - middle) ** 2 for v in values)
    serial = sum((a - middle) * (b - middle) for a, b in zip(values, values[1:])) / square if square else 1.0
    correlated = two_sided((serial + 1 / n) * math.sqrt(n))
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, runs, correlated))
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def frequent_words(docs: DataFrame) -> list[str]:
    """The most frequent words of 3 to 12 letters a to z of all whole texts, at most FREQUENT; the fixed ones if there are few."""
    words = docs.select(F.explode(F.split(F.lower(text_or_empty("text")), r"[\s.,;:!?\"()]+")).alias("w")).filter("w RLIKE '^[a-z]{3,12}$'")
    counts = words.groupBy("w").count().filter(F.col("count") >= TIMES)
    own = [r["w"] for r in counts.orderBy(F.desc("count"), "w").limit(FREQUENT).collect()]
    return own if len(own) >= len(WORDS) else own + WORDS


def decoy(rng: random.Random, code: int, length: int, words: list[str], hex_words: list[str]) -> str:
    """Words and numbers joined in an encoding."""
    name, alphabet = ENCODINGS[code]
    marks = [c for c in "/+-_" if c in alphabet]
    out = ""
    while len(out) < length:
        number = rng.choice([f"20{rng.randrange(30):02}", f"{rng.randrange(1, 13):02}", str(rng.randrange(100)), "000", "123", "1000", str(rng.randrange(10))])
        if name == "decimal" or ("0" in alphabet and rng.random() < 0.3):
            part = number
        elif name.endswith("hex"):
            part = rng.choice(hex_words)
        else:
            part = rng.choice(words)
        if "a" not in alphabet:
            part = part.upper()
        elif "A" in alphabet and rng.random() < 0.7:
            part = part.capitalize()
        out += part + (rng.choice(marks) if marks and rng.random() < 0.7 else "")
    return out[:length]


def levels_of(code: int, size: int, words: list[str]) -> list[float]:
    """Item n - 1 is the least combined p value in this encoding and range of lengths whose share of decoys is CHANCES[n].

    Ends before the first step that no string can reach.
    """
    rng = random.Random(100 * code + size)
    hex_words = HEX_WORDS + [w for w in words if set(w) <= set("abcdef")]
    low, high = LENGTHS[size], LENGTHS[size + 1] if size + 1 < len(LENGTHS) else LENGTHS[size] + 32
    looks = sorted(randomness(decoy(rng, code, rng.randrange(low, high), words, hex_words), code) for _ in range(DECOYS))
    tail = [max(NARROW, -math.log(max(p, 1e-300))) for p in looks[-TAIL:]]  # distances from a p value of 1
    power = max(NARROW, sum(math.log(tail[0] / t) for t in tail) / TAIL)
    out: list[float] = []
    for chance in CHANCES[1:]:
        if chance * (1 + DECOYS) >= TAIL:
            level = math.nextafter(looks[DECOYS - int(chance * (1 + DECOYS))], 2)
        else:
            level = math.exp(-tail[0] * (chance * DECOYS / TAIL) ** power)
        if level > 1:
            break
        out.append(max([level, *out[-1:]]))
    return out


Levels = dict[tuple[int, int], list[float]]
#: The levels that were asked for last, with their words.
_last: list[tuple[list[str], Levels]] = []


def decoy_levels(docs: DataFrame) -> Levels:
    """What ``levels_of`` gives for every encoding and range of lengths, a list of at most STEPS numbers each."""
    words, ranges = frequent_words(docs), len(LENGTHS)
    if _last and _last[0][0] == words:
        return _last[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(0).to_pylist()
            told = pa.array([levels_of(*divmod(c, ranges), words) for c in cells], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), told], names=["cell", "levels"])

    n = len(ENCODINGS) * ranges
    rows = docs.sparkSession.range(0, n, 1, n).mapInArrow(run, "cell long, levels array<double>").collect()
    _last[:] = [(words, {divmod(r["cell"], ranges): r["levels"] for r in rows})]
    return _last[0][1]


def tested_step(text: str, size: int, levels: Levels) -> int:
    """The step of a string's p value, CHANCES[step] at most; 0 for what isn't random at all."""
    bare = text.rstrip("=")
    code = encoding(bare)
    own = randomness(bare, code)
    return 0 if own < FLOOR else bisect.bisect_right(levels[code, size], own)


def found(text: str, levels: Levels) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """Spans of the fixed patterns as (start, kind, end), and others that were tested as (start, end, range, step)."""
    spans, tested = [], []
    lower = text.lower()
    if any([name in lower for name in NAMES]):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for word in LONG.finditer(text):
        at, run = word.start(), word[0]
        if "AKIA" in run:
            spans += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(run) if len(m[0]) >= 20]
        spans += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(run) if len(m[0]) >= 24]
        for m in CANDIDATE.finditer(run):
            start, end = at + m.start(), at + m.end()
            if not any([b < end and start < e for b, _, e in spans]):
                size = sum(len(m[0]) >= n for n in LENGTHS) - 1
                tested.append((start, end, size, tested_step(m[0], size, levels)))
    return sorted(spans), tested


SCANNED = "doc_id long, base array<struct<start:long,kind:int,end:long>>, tested array<struct<start:long,end:long,size:int,step:int>>"
_BASE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_TESTED = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("size", pa.int32()), ("step", pa.int32())])
)


def scan(docs: DataFrame, levels: Levels | None = None) -> DataFrame:
    """doc_id, spans of the fixed patterns and the strings that were tested, for every row; levels from ``docs`` if None."""
    levels = decoy_levels(docs) if levels is None else levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [found(text, levels) for text in batch.column(1).to_pylist()]
            base = [[{"start": s, "kind": k, "end": e} for s, k, e in spans] for spans, _ in results]
            tested = [
                [{"start": s, "end": e, "size": n, "step": p} for s, e, n, p in strings] for _, strings in results
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, _BASE), pa.array(tested, _TESTED)], names=["doc_id", "base", "tested"]
            )

    return docs.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).mapInArrow(run, SCANNED)


def least_steps(scanned: DataFrame, share: float = SHARE) -> list[int]:
    """For each range of lengths the lowest step at which Benjamini and Hochberg's rule holds for ``share``.

    STEPS where there is none.  The counts of the whole corpus come to the driver: len(LENGTHS) * STEPS rows at most.
    """
    counts = scanned.select(F.inline("tested")).groupBy("size", "step").count().collect()
    out = []
    for size in range(len(LENGTHS)):
        own = {r["step"]: r["count"] for r in counts if r["size"] == size}
        held = (n for n in range(FIRST, STEPS) if 0 < sum(own.values()) * CHANCES[n] <= share * sum(own.get(s, 0) for s in range(n, STEPS)))
        out.append(next(held, STEPS))
    return out


def secrets(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """Spans of secrets in every whole text, in code points, ends exclusive.

    ``docs`` needs doc_id and text; other columns are ignored.  A null text counts as empty.  Returns a row per row,
    repeated ones too: doc_id, n_assign, n_access, n_hex, base (array), base_spans, spans and n_random.  A random string
    that overlaps a span of a fixed pattern isn't reported again.
    """
    scanned = stored(scan(docs), "secrets")
    least = ",".join(map(str, least_steps(scanned, share)))
    kinds = ",".join(f"'{k}'" for k in KINDS)
    added = f"""transform(
        filter(tested, t -> t.step >= array({least})[t.size]),
        t -> named_struct('start', t.start, 'kind', {len(KINDS) - 1}, 'end', t.end))"""
    told = "array_join(transform({0}, s -> concat_ws(':', array({1})[s.kind], s.start, s.end)), ',')"
    return scanned.withColumn("added", F.expr(added)).selectExpr(
        "doc_id",
        *[f"cast(size(filter(base, b -> b.kind = {i})) AS long) AS n_{k}" for i, k in enumerate(KINDS[:3])],
        "base",
        told.format("base", kinds) + " AS base_spans",
        told.format("array_sort(concat(base, added))", kinds) + " AS spans",
        "cast(size(added) AS long) AS n_random",
    )


def masked(text: str, least: list[int], levels: Levels) -> str:
    """``text`` with each secret replaced by the name of its kind."""
    spans, tested = found(text, levels)
    spans = spans + [(s, len(KINDS) - 1, e) for s, e, size, step in tested if step >= least[size]]
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """All rows of ``docs`` with secrets masked in text, and n_chars, if there is such a column, counted anew.

    Null texts stay null, repeated rows stay repeated, an empty table stays empty.  Texts are scanned twice, for the
    counts and to be masked: keeping their spans would take a join on rows that nothing tells apart.
    """
    levels = decoy_levels(docs)
    least = least_steps(stored(scan(docs, levels), "secrets"), share)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: masked(t, least, levels), na_action="ignore")

    out = docs.withColumn("text", clean("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
