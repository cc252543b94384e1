import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tillroll.llm.resampling import bucket_counts, draw, gram_codes, packed, resample, words_of


def grams(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + n]) for i in range(len(words)) for n in (1, 2, 3) if i + n <= len(words)]


def buckets(text):
    return Counter(zlib.crc32(g.encode()) % 10_000 for g in grams(text)[1])


def brute(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s += buckets(text)
    for text in target:
        t += buckets(text)
    all_s, all_t = sum(s.values()), sum(t.values())
    rows, able = [], []
    for doc, text in docs:
        n_words, found = grams(text)
        weight = sum(
            n * math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b, n in buckets(text).items()
        )
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(found), weight, score))
        if n_words >= 20:
            able.append((-score, doc is None, doc, len(rows) - 1))
    ranks = {row: i + 1 for i, (*_, row) in enumerate(sorted(able)[: 5 * len(able) // 100])}
    return sorted(((*row, ranks.get(i)) for i, row in enumerate(rows)), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = ["Alpha", "beta2", "été", "漢字", "x", "Ünder", "the", "of", "😀", "9"]
    gaps = [" ", "  ", "\n", "-", "_", "\x00", "\x7f", "; ", "\t"]
    docs = [(i, "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.choice([0, 1, 3, 19, 20, 21, 60])))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, " .. "), (1003, "one"), (1004, "É É"), (1005, "word " * 120_000)]
    docs += [(1006, docs[5][1]), (1006, docs[5][1])]
    return docs, ["the of alpha beta2 the of", None, "été x"]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, target = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = resample(frame, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, target)
    ranks = sorted(r.rank for r in got if r.rank is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_odd_rows(spark, odd, empty):
    target = spark.createDataFrame([("word word",)], "text string")
    got = resample(odd, target)
    assert got.count() == odd.count() and draw(odd, target, 100).columns == odd.columns
    assert resample(empty, target).count() == 0
    assert resample(odd, target.limit(0)).count() == odd.count()


def test_spans_of_long_texts():
    words = words_of(("Ab 漢 " * 200_000).encode())
    codes = [c for block in gram_codes(words) for c in block]
    assert Counter(codes) == Counter(zlib.crc32(g.encode()) for g in grams("ab 漢 " * 200_000)[1])
    found, counts = bucket_counts(words)
    pairs = np.frombuffer(packed(found, counts), '<u2').reshape(-1, 2)
    assert len(pairs) > len(found) and pairs[:, 1].sum() == counts.sum() and set(pairs[:, 0]) == set(found)
    assert counts.sum() == len(codes) and len(found) == len({c % 10_000 for c in codes})
