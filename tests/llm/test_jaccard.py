import random
from itertools import combinations

import numpy as np
import pyarrow as pa
from test_minhash import corpus, words_set

from tillroll.llm import cells, jaccard
from tillroll.llm.cells import add_overlaps, cells_of, forest
from tillroll.llm.jaccard import jaccard_join
from tillroll.llm.shingles import shingle_sets


def brute(rows, percent=80):
    sets = [words_set(text) for _, text in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((doc, len(s), least[find(i)], links[i]) for i, ((doc, _), s) in enumerate(zip(rows, sets)))


def alike(seed, n=300, words=200, changes=6):
    """Many copies of one text with a few changed words each, most of them not similar enough to link."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(1000)}" for _ in range(words)]
    texts = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(words)] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    return texts


def test_equals_brute_force(spark):
    """Three corpora with a large group of alike texts each, repeated rows and a document of two texts, in one run."""
    rows = []
    for seed in range(1, 4):
        own = corpus(seed)
        own += list(enumerate(alike(seed, 120), 5_000)) + [own[3], (own[4][0], own[40][1])]
        rows += [(10_000 * seed + doc, text) for doc, text in own]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in jaccard_join(docs).collect())
    assert got == brute(rows)


def test_packed_groups_are_hashed_in_small_parts(spark, monkeypatch):
    sizes, texts = [], [" ".join(f"t{i}w{j}" for j in range(60_000)) for i in range(10)]

    class Held:
        def select(self, *_):
            return self

        def mapInArrow(self, run, columns):
            return run

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 0

    def counting(some):
        sizes.append(sum(map(len, some)))
        return shingle_sets(some)

    monkeypatch.setattr(jaccard, "TaskContext", Task)
    monkeypatch.setattr(jaccard, "shingle_sets", counting)
    run = jaccard._lone_posts(Held(), 16, 4)
    (rows,) = [b.to_pylist() for b in run(iter([pa.RecordBatch.from_pydict({"text": texts})]))]
    assert sum(map(len, texts)) < jaccard.CHARACTERS and max(sizes) < 3_000_000
    assert sum(len(r["grams"]) // 8 for r in rows) == 10 * (60_000 - 4) and [len(r["nodes"]) for r in rows] == 4 * [80]


def test_any_fragments_and_percent(spark, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK_NODES", 7)
    rows = list(enumerate(alike(5, 60))) + corpus(9)[:80]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for percent, fragments in ((60, 3), (95, 20)):
        assert sorted(tuple(r) for r in jaccard_join(docs, percent, fragments).collect()) == brute(rows, percent)


def test_large_group_leaves_few_rows(spark):
    n = 1200
    posts = spark.range(n).selectExpr("id AS node", "explode(sequence(0, 30)) AS key").selectExpr("CAST(key AS long) AS key", "node")
    made = cells_of(posts, spark.range(n).selectExpr("id AS node", "100L AS entries")).collect()
    assert len(made) <= 8 * n
    seen = {}
    for r in made:
        seen.setdefault((r.low, r.high), {}).setdefault(r.block, set()).add(r.node)
    blocks = {b: nodes for parts in seen.values() for b, nodes in parts.items()}
    assert sum(map(len, blocks.values())) == n
    assert {(a, b) for a in blocks for b in blocks if a <= b} == set(seen)


def test_odd_rows(odd, empty):
    got = jaccard_join(odd)
    assert got.count() == odd.count() and jaccard_join(empty).count() == 0
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[5].component_id == 1 and by_id[5].n_links == 2 and by_id[2].n_shingles == 0 and by_id[None].component_id is None


def test_overlaps_and_forest(monkeypatch):
    rng = np.random.default_rng(4)
    for products, heavy in ((1 << 22, 256), (3, 4), (1, 10**9), (1 << 22, 1)):
        monkeypatch.setattr(cells, "PRODUCTS", products)
        monkeypatch.setattr(cells, "HEAVY", heavy)
        sets = [[np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype("<u8")) for _ in range(k)] for k in (9, 14)]
        total = np.zeros((9, 14), np.int32)
        add_overlaps(total, *[(np.repeat(np.arange(len(s)), [len(x) for x in s]), np.concatenate(s)) for s in sets])
        assert total.tolist() == [[len(np.intersect1d(a, b)) for b in sets[1]] for a in sets[0]]
    linked = np.array([[1, 0, 0], [0, 0, 1], [1, 0, 0], [0, 0, 0]], bool)
    edges = list(forest(linked, np.array([10, 20, 30, 40]), np.array([1, 2, 3])))
    assert sorted(edges) == [(1, 10), (1, 30), (3, 20)]
