import random
from collections import defaultdict
from itertools import combinations

import numpy as np

from tillroll.llm import cells, minhash
from tillroll.llm.common import stored
from tillroll.llm.minhash import components, drop_near_copies, near_duplicates
from tillroll.llm.shingles import shingle_sets


def words_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    sets = {doc: words_set(text) for doc, text in rows}
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def corpus(seed):
    """Copies, chains of edits, a passage that many share, a large group of near copies, and odd texts."""
    rng = random.Random(seed)

    def prose(n):
        return [rng.choice("abcdefghijklmnop") + str(rng.randrange(400)) for _ in range(n)]

    texts = [None, "", " \n", "one two", "One  TWO", "one two three four five", "É x y z w", "é x y z w"]
    passage = prose(60)
    for _ in range(60):
        texts.append(" ".join(prose(rng.randrange(5, 60)) + passage))
    base = prose(120)
    for _ in range(60):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(len(own))] = "edit" + str(rng.randrange(10**6))
        texts.append(" ".join(own))
    chain = prose(80)
    for i in range(12):
        chain = chain[1:] + [f"next{i}"]
        texts.append("\n".join(chain))
    for _ in range(40):
        texts.append(" ".join(prose(rng.randrange(1, 80))))
    texts += rng.choices(texts, k=30)
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


def alike(seed, n, words=200, changes=4):
    """Copies of one text with some changed words each: most aren't similar enough to each other, or to any one of them."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(1000)}" for _ in range(words)]
    texts = []
    for _ in range(n):
        own = list(base)
        for _ in range(changes):
            own[rng.randrange(words)] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    return texts


def test_large_groups_leave_few_rows(spark, monkeypatch):
    rows = list(enumerate(alike(3, 300)))
    made = {}

    def counted(df, name):
        out = stored(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    for module in (minhash, cells):
        monkeypatch.setattr(module, "stored", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    assert made["links"] <= 4 * len(rows) and made["cells"] <= 4 * len(rows)


def test_components_equal_brute_force(spark):
    """Five corpora with a large group of alike texts each, in one run."""
    rows = []
    for seed in range(1, 6):
        rows += [(10_000 * seed + doc, text) for doc, text in corpus(seed) + list(enumerate(alike(seed, 90), 5000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_odd_rows(odd, empty):
    got = near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].component_id == 1 and not by_id[5].kept and by_id[2].kept and by_id[2].n_shingles == 0
    assert by_id[None].kept and by_id[9].n_shingles == 1
    assert drop_near_copies(odd).columns == odd.columns
    assert near_duplicates(empty).count() == 0


def test_shingles_match_words():
    rng = random.Random(3)
    texts = ["".join(rng.choices("aAbB éÉ\n\t\x0b\x1c\x85\xa0", k=rng.randrange(60))) for _ in range(500)]
    seen = defaultdict(set)
    for text, hashes in zip(texts, shingle_sets(texts)):
        own = words_set(text)
        assert len(hashes) == len(own) and np.all(hashes[:-1] < hashes[1:])
        seen[tuple(sorted(own))].add(hashes.tobytes())
    assert all(len(v) == 1 for v in seen.values()) and len({next(iter(v)) for v in seen.values()}) == len(seen)


def test_long_chains_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}
