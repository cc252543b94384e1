import re
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillroll.functions.ids import with_integer_ids
from tillroll.operators import basket, content, interactions, item_cf, user_cf, pairs
from tillroll.operators.pairs import _least_blocks, _met_blocks, _paired_blocks, co_occurrence, nearest_rows

SCHEMA = "description string, customer_id bigint, invoice_no string"


def skewed_lines(spark, n=1500, items=60, seed=5):
    """Lines where one customer, one item and one invoice each hold a third."""
    rng = np.random.default_rng(seed)
    customer = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 40, n))
    item = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, items, n))
    invoice = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 200, n))
    rows = [(f"ITEM {i:03}", int(c), f"{v}") for i, c, v in zip(item, customer, invoice)]
    return spark.createDataFrame(rows, SCHEMA).repartition(6), rows


def sets(rows, key, value):
    out = {}
    for r in rows:
        out.setdefault(r[key], set()).add(r[value])
    return out


CUTTINGS = [{}, {"large_group": 5, "block_items": 300, "slab_groups": 16}, {"large_group": 0}]


@pytest.mark.parametrize("cutting", CUTTINGS)
def test_item_cosine_is_whole_and_exact(spark, cutting):
    lines, rows = skewed_lines(spark)
    got = {
        (r.item_a, r.item_b): (r.common, r.similarity)
        for r in item_cf.item_cosine(interactions.stored_counts(lines), 5, **cutting).collect()
    }
    buyers = sets(rows, 0, 1)
    popular = {i for i in buyers if sum(r[0] == i for r in rows) >= 5}
    want = {}
    for a in popular:
        for b in popular - {a}:
            common = len(buyers[a] & buyers[b])
            if common:
                want[a, b] = (common, common / (len(buyers[a]) * len(buyers[b])) ** 0.5)
    assert got.keys() == want.keys()
    for k, (common, similarity) in want.items():
        assert got[k][0] == common and got[k][1] == pytest.approx(similarity)
        assert got[k][1] <= 1 + 1e-12 and got[k][1] == got[k[::-1]][1]


@pytest.mark.parametrize("cutting", CUTTINGS)
def test_rules_match_brute_force(spark, cutting):
    lines, rows = skewed_lines(spark)
    rules = basket.association_rules(interactions.stored_counts(lines, "invoice_no"), 5, **cutting).collect()
    buyers = sets(rows, 0, 2)
    popular = {i for i in buyers if sum(r[0] == i for r in rows) >= 5}
    invoices = len({r[2] for r in rows if r[0] in popular})
    want = {}
    for a, b in combinations(sorted(popular), 2):
        together = len(buyers[a] & buyers[b])
        if together >= 3:
            lift = together * invoices / (len(buyers[a]) * len(buyers[b]))
            want[a, b] = (together / len(buyers[a]), lift)
            want[b, a] = (together / len(buyers[b]), lift)
    got = {(r.item_a, r.item_b): (r.confidence, r.lift) for r in rules}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k]) and got[k][0] <= 1 and got[k][1] == got[k[::-1]][1]


def test_weights_are_summed_over_groups(spark):
    rows = [(g, i, float(1 + (g + i) % 3)) for g in range(8) for i in range(10)]
    members = spark.createDataFrame(rows, "grp int, item bigint, weight double")
    want = {}
    for a, b in combinations(range(10), 2):
        want[a, b] = sum((1 + (g + a) % 3) * (1 + (g + b) % 3) for g in range(8))
    for cutting in ({}, {"large_group": 3, "block_items": 4, "slab_groups": 3}):
        got = {(r.a, r.b): r.together for r in co_occurrence(members, **cutting).collect()}
        assert got == want


def top_of(similarity, n):
    ranked = sorted(((-round(s, 9), k) for k, s in similarity.items() if s > 0))[:n]
    return [k for _, k in ranked]


@pytest.mark.parametrize("block_rows", [2048, 7])
def test_nearest_customers_match_brute_force(spark, block_rows):
    lines, rows = skewed_lines(spark)
    baskets = sets([r for r in rows if sum(x[0] == r[0] for x in rows) >= 3], 1, 0)
    got = {}
    found = user_cf.nearest_customers(interactions.stored_counts(lines), block_rows=block_rows).collect()
    for r in sorted(found, key=lambda r: r.rank):
        got.setdefault(r.customer_id, []).append(r.neighbor)
    for c, mine in baskets.items():
        near = {o: len(mine & b) / (len(mine) * len(b)) ** 0.5 for o, b in baskets.items() if o != c}
        assert got[c] == top_of(near, 5), c


def test_nearest_customers_of_targets_only(spark):
    lines, _ = skewed_lines(spark)
    counts = interactions.stored_counts(lines)
    everyone = {(r.customer_id, r.rank, r.neighbor) for r in user_cf.nearest_customers(counts).collect()}
    wanted = spark.createDataFrame([(0,), (7,), (999,)], "customer_id bigint")
    some = {
        (r.customer_id, r.rank, r.neighbor)
        for r in user_cf.nearest_customers(counts, targets=wanted, block_rows=9).collect()
    }
    assert some == {x for x in everyone if x[0] in (0, 7)}


def test_identical_customers_find_each_other(spark):
    rows = [("A", c, str(c)) for c in (1, 2)] + [("B", c, str(c)) for c in (1, 2)] + [("A", 3, "3"), ("C", 3, "3")] * 3
    near = user_cf.nearest_customers(interactions.stored_counts(spark.createDataFrame(rows, SCHEMA)), min_purchases=1)
    first = {r.customer_id: r.neighbor for r in near.collect() if r.rank == 1}
    assert first[1] == 2 and first[2] == 1


def test_neighbour_recommendations_skip_own_items(spark):
    lines, rows = skewed_lines(spark)
    counts = interactions.stored_counts(lines)
    near = user_cf.nearest_customers(counts)
    neighbors = sets([(r.customer_id, r.neighbor) for r in near.collect()], 0, 1)
    baskets = sets([r for r in rows if sum(x[0] == r[0] for x in rows) >= 3], 1, 0)
    for r in user_cf.recommend_from_neighbors(counts, near).collect():
        assert r.item not in baskets[r.customer_id] and r.rank <= 5
        share = np.mean([r.item in baskets[o] for o in neighbors[r.customer_id]])
        assert r.score == pytest.approx(round(share, 2))


@pytest.mark.parametrize("targets", [None, ["ITEM 000", "ITEM 007", "NONE"]])
def test_weighted_similarity(spark, targets):
    lines, rows = skewed_lines(spark)
    asked = None if targets is None else spark.createDataFrame([(t,) for t in targets], "description string")
    found = item_cf.similar_items_weighted(interactions.stored_counts(lines), 5, asked).collect()
    got = {}
    for r in sorted(found, key=lambda r: r.rank):
        got.setdefault(r.description, []).append((r.item, r.score))
    items = sorted({r[0] for r in rows})
    m = np.zeros((len(items), 40))
    for i, c, _ in rows:
        m[items.index(i), c] += 1
    cos = m @ m.T / np.sqrt(np.outer((m * m).sum(1), (m * m).sum(1)))
    for i in items if targets is None else [t for t in targets if t in items]:
        best = np.sort(np.delete(cos[items.index(i)], items.index(i)))[::-1][:5]
        assert [s for _, s in got[i]] == pytest.approx(best[best > 0].tolist())
    if targets is not None:
        assert set(got) == {"ITEM 000", "ITEM 007"}


def test_target_rules_prune_nothing_that_counts(spark):
    lines, rows = skewed_lines(spark)
    counts = interactions.stored_counts(lines, "invoice_no")
    buyers, total = sets(rows, 0, 2), len({r[2] for r in rows})
    want = {}
    for a in buyers:
        found = []
        for b in set(buyers) - {a}:
            both = len(buyers[a] & buyers[b]) / total
            if both >= 0.02:
                found.append((-(both / (len(buyers[a]) / total) / (len(buyers[b]) / total)), b))
        if found:
            want[a] = [-v for v, _ in sorted(found)[:5]]
    for targets in (None, sorted(buyers)[:3]):
        asked = None if targets is None else spark.createDataFrame([(t,) for t in targets], "description string")
        got = {}
        for r in basket.rules_for_targets(lines, counts, asked, min_support=0.02).orderBy("rank").collect():
            got.setdefault(r.description, []).append(r.lift)
        expected = {k: v for k, v in want.items() if targets is None or k in targets}
        assert got.keys() == expected.keys()
        for k in got:
            assert got[k] == pytest.approx(expected[k])


def test_lookup_falls_back_for_unknown_items(spark):
    recs = spark.createDataFrame([("A", 1, "B", 0.5), ("A", 2, "C", 0.4)], "description string, rank int, item string, score double")
    best = spark.createDataFrame([(1, "X", 9.0), (2, "Y", 8.0)], "rank int, item string, score double")
    asked = spark.createDataFrame([("A",), ("?",)], "description string")
    got = interactions.lookup_or_fallback(asked, recs, best, "description", ["item", "score"]).collect()
    assert {(r.description, r.rank, r.item, r.is_fallback) for r in got} == {
        ("A", 1, "B", False), ("A", 2, "C", False), ("?", 1, "X", True), ("?", 2, "Y", True),
    }


def test_integer_ids_are_unique_and_repeatable(spark):
    df = spark.range(5000).selectExpr("concat('k', id) AS k")
    one = {r.k: r.n for r in with_integer_ids(df, "k", "n", 16).collect()}
    two = {r.k: r.n for r in with_integer_ids(df.repartition(7), "k", "n", 16).collect()}
    assert one == two and len(set(one.values())) == 5000 and max(one.values()) < 5000 * 1.3


def test_tfidf_by_hand(spark):
    texts = spark.createDataFrame([(1, "The red mug x"), (2, "red red PLATE"), (3, "größe plate_1")], "k int, t string")
    got = {(r.k, r.token): r for r in content.tfidf(texts, "k", "t", ["the"]).collect()}
    assert set(got) == {(1, "red"), (1, "mug"), (2, "red"), (2, "plate"), (3, "größe"), (3, "plate_1")}
    idf = lambda df: np.log(4 / (1 + df)) + 1
    length = np.hypot(2 * idf(2), idf(1))
    assert got[2, "red"].tf == 2 and got[2, "red"].weight == pytest.approx(2 * idf(2) / length)


def test_similar_texts_to_targets(spark):
    texts = spark.createDataFrame([("red mug",), ("red plate",), ("blue cup",), ("mug red",)], "d string")
    weights = content.tfidf(texts.selectExpr("d", "d AS t"), "d", "t", [])
    asked = spark.createDataFrame([("red mug",), ("unknown",)], "d string")
    got = content.similar_texts(weights, "d", targets=asked).orderBy("rank").collect()
    assert [(r.d, r.item) for r in got] == [("red mug", "mug red"), ("red mug", "red plate")]
    assert got[0].score == 100.0


def test_dense_and_sparse_products_agree(spark):
    rng = np.random.default_rng(0)
    dense = rng.random((40, 30)) * (rng.random((40, 30)) < 0.6)
    rows = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    df = spark.createDataFrame(rows, "k int, d int, w double")
    got = {(r.k, r.neighbor): r.similarity for r in nearest_rows(df, "k", "d", "w", 40, block_rows=11).collect()}
    product = dense @ dense.T
    for (a, b), s in got.items():
        assert s == pytest.approx(product[a, b])
    assert len(got) == 40 * 39


def test_every_pair_of_rows_meets_in_one_cell_and_rows_are_sent_once_per_block(spark):
    blocks, n = 6, 60
    cells = _paired_blocks(spark.range(n).withColumnRenamed("id", "key"), blocks).collect()
    assert len(cells) == blocks * n  # two copies per block when each side was sent by itself
    sides = {}
    for r in cells:
        cell = sides.setdefault((r.lb, r.rb), (set(), set(), r.both))
        assert r.both == cell[2] == (r.lb != r.rb)
        for mark, side in ((r.first, cell[0]), (r.second, cell[1])):
            if mark:
                side.add(r.key)
    met = [frozenset((a, b)) for first, second, _ in sides.values() for a in first for b in second if a < b or (first != second and a != b)]
    assert len(met) == len(set(met)) == n * (n - 1) // 2
    assert [_least_blocks(t) for t in (1, 2, 3, 8, 36, 37)] == [1, 2, 2, 4, 8, 9]


def test_large_groups_go_to_their_own_blocks_only(spark):
    rows = [(g, 10 * block + i, block, 1.0) for g, own in ((1, (0, 7)), (2, (3,)), (3, tuple(range(8)))) for block in own for i in range(3)]
    members = spark.createDataFrame(rows, "grp long, item long, block int, weight double")
    sent = {}
    for r in _met_blocks(members, F.lit(1), []).collect():
        assert sorted(r["items"]) == [10 * r.block + i for i in range(3)]
        sent.setdefault(r.grp, []).append((r.i, r.j))
    assert sorted(sent[1]) == [(0, 0), (0, 7), (0, 7), (7, 7)] and sent[2] == [(3, 3)] and len(sent[3]) == 64


def test_rows_of_few_entries_are_sent_to_few_blocks(spark, monkeypatch):
    made = []

    def counted(packed, blocks):
        made.append(blocks)
        return _paired_blocks(packed, blocks)

    monkeypatch.setattr(pairs, "_paired_blocks", counted)
    rows = spark.range(40_000).selectExpr("id AS k", "id % 20000 AS d", "1D AS w")
    nearest_rows(rows, "k", "d", "w", 1)
    assert made == [_least_blocks(spark.sparkContext.defaultParallelism)]


@pytest.mark.parametrize("n_left, n_right, dims, n", [(50, 70, 20, 5), (300, 300, 50, 5), (4, 3, 5, 5), (200, 200, 1000, 3)])
def test_best_rows_of_two_blocks_are_those_of_the_whole_product(monkeypatch, n_left, n_right, dims, n):
    monkeypatch.setattr("tillroll.functions.sparseblocks.STRIP_CELLS", 700)
    random = np.random.default_rng(n_left)

    def block(rows):
        cells = np.unique(np.stack([np.repeat(np.arange(rows), 6), random.integers(0, dims, rows * 6)], 1), axis=0)
        return cells[:, 0], cells[:, 1], 1 / np.sqrt(np.bincount(cells[:, 0], minlength=rows)[cells[:, 0]])

    def dense(b, rows):
        out = np.zeros((rows, dims))
        out[b[0], b[1]] = b[2]
        return out

    left, right = block(n_left), block(n_right)
    l_key, r_key = random.permutation(n_left), random.permutation(n_right) + 2
    product = dense(left, n_left) @ dense(right, n_right).T
    found = sorted((int(r), -round(s, 9), int(r_key[c])) for r, c, s in zip(*pairs._best_rows(l_key, left, r_key, right, n)))
    expected = []
    for r in range(n_left):
        others = [(r, -round(s, 9), int(k)) for s, k in zip(product[r].tolist(), r_key) if s > 1e-12 and k != l_key[r]]
        expected += sorted(others)[:n]
    assert found == expected


def test_words_of_a_text_are_counted_where_it_lies(spark, monkeypatch):
    plans = {}

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return df

    monkeypatch.setattr(content, "durable", kept)
    texts = spark.createDataFrame([(1, "mug red mug"), (2, "red pot"), (3, None)], "k bigint, text string")
    rows = {(r.k, r.token): (r.tf, r.df, r.weight) for r in content.tfidf(texts, "k", "text", []).collect()}
    assert "hashpartitioning(k#" in plans["tf"] and plans["tf"].count("Exchange") == 1
    assert "token" not in plans["tf"].split("hashpartitioning(")[1].split(")")[0]
    mug, red = 2 * (np.log(3 / 2) + 1), np.log(3 / 3) + 1
    assert {k: v[:2] for k, v in rows.items()} == {(1, "mug"): (2, 1), (1, "red"): (1, 2), (2, "red"): (1, 2), (2, "pot"): (1, 1)}
    assert rows[1, "mug"][2] == pytest.approx(mug / np.hypot(mug, red))


def test_pairs_of_a_task_are_bounded(spark):
    """The map-side sum of a task holds its pairs: with a set number of tasks it grew with the groups."""
    members = spark.range(200).selectExpr("id % 20 AS grp", "id AS item", "1D AS weight")  # 20 groups of 45 pairs
    usual, cut = co_occurrence(members), co_occurrence(members, task_pairs=45)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "hashpartitioning(grp" in plan
    assert re.search(r"hashpartitioning\(grp#\d+L?, 20\), REPARTITION_BY_NUM", plan)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, usual.collect())) and cut.count() == 900


def test_counts_stay_where_they_lie_to_meet_few_popular_items(spark):
    lines = spark.range(40_000).selectExpr(
        "concat('ITEM ', CASE WHEN id < 3 THEN -id - 1 ELSE id % 50 END) AS description", "id * 7919 % 9973 AS customer_id"
    )
    counts = interactions.stored_counts(lines)
    size = int(counts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    broadcasts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size // 4))
    try:
        bought = interactions.binary_interactions(counts)
        plan = bought._jdf.queryExecution().executedPlan().toString()
        rows = sorted(map(tuple, bought.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
    assert "Exchange hashpartitioning" not in plan
    seen = {(r.description, r.customer_id) for r in lines.collect()}
    assert rows == sorted(r for r in seen if "-" not in r[0]) and len(rows) < len(seen)


def _random_rows(random, rows, dims, keys):
    """Rows of which half share dim 0, dense and as bundles are made of them."""
    has = random.random((rows, dims)) < np.where(np.arange(dims) == 0, 0.5, 20 / dims)
    has[:, 1] |= ~has.any(axis=1)
    weights, (row, dim) = has / np.sqrt(has.sum(1))[:, None], np.nonzero(has)
    entries = pa.StructArray.from_arrays([pa.array(dim), pa.array(weights[row, dim])], ["dim_id", "w"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has.sum(1))]), pa.int32()), entries)
    return weights, pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array(np.zeros(rows, dtype=bool)), pa.array(np.ones(rows)), lists], ["key", "asks", "length", "v"]
    )


@pytest.mark.parametrize("alone", [False, True])
def test_cells_that_cannot_be_among_the_best_are_not_multiplied(monkeypatch, alone):
    """Two blocks of rows, sent as compressed bundles: before, every cell of their product was made and ordered, once for each side."""
    monkeypatch.setattr(pairs, "TILE_ROWS", 1024)
    monkeypatch.setattr(pairs, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    whole = []

    def counted(product):
        for first, strip in strips(product):
            whole.append(strip.size)
            yield first, strip

    strips = pairs.Product.strips
    monkeypatch.setattr(pairs.Product, "strips", counted)
    random, rows, n = np.random.default_rng(7), 3000, 3
    keys = [np.sort(random.permutation(10_000)[:rows]) + side * 10_000 for side in (0, 1)]
    dense, sides = [], []
    for k in keys:
        weights, batch = _random_rows(random, rows, 1500, k)
        shuffled = batch.take(pa.array(random.permutation(rows)))
        bundles = [r["bundle"] for b in pairs._bundled(100, 5000)([shuffled]) for r in b.to_pylist()]
        dense.append(weights)
        sides.append(pairs._Side(bundles))
        assert len(bundles) >= 30 and sum(map(len, bundles)) < 16 * np.count_nonzero(weights) / 2
    left, right = (sides[0], None) if alone else sides
    found = {}
    for mine, others, similarity in pairs._best_of_sides(left, right, n, not alone):
        for k, o, s in zip(mine.tolist(), others.tolist(), similarity.tolist()):
            found.setdefault(k, []).append((-round(s, 9), o))
    for mine, others in ((0, 0),) if alone else ((0, 1), (1, 0)):
        product = dense[mine] @ dense[others].T
        for k, row in zip(keys[mine].tolist(), product):
            expected = sorted((-round(s, 9), o) for s, o in zip(row.tolist(), keys[others].tolist()) if s > 1e-12 and o != k)[:n]
            assert sorted(found[k])[:n] == expected
    assert sum(whole) < (0.5 if alone else 0.7) * rows * rows, sum(whole) / rows**2


@pytest.mark.parametrize("carried", [False, True])
def test_pairs_that_meet_often_are_summed_once(spark, monkeypatch, carried):
    """Tasks' sums used to be exchanged once per task and pair; now a pair is summed where all its groups come together."""
    random = np.random.default_rng(11)
    rows = [(g, i, float(random.integers(1, 4)), i / 7) for g in range(400) for i in random.permutation(37)[: random.integers(0, 30)].tolist()]
    members = spark.createDataFrame(rows, "grp int, item bigint, weight double, square double").repartition(5)
    members = members if carried else members.drop("square")
    usual = pairs.MET_OFTEN
    found = []
    for often in (usual, float("inf")):
        monkeypatch.setattr(pairs, "MET_OFTEN", often)
        monkeypatch.setattr(pairs, "BLOCK_PRODUCTS", 50)
        sums = co_occurrence(members)
        found.append(sorted(map(tuple, sums.collect())))
        plan = sums._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" in plan or "HashJoin" in plan) == (often != usual)
    assert found[0] == found[1] and len(found[0]) == 37 * 36 // 2


def test_numbered_words_give_the_same_nearest_texts(spark, monkeypatch):
    """Words used to be exchanged twice more to be numbered, and weights of texts were sent as doubles of their own."""
    random = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{min(w, 60)}" for w in random.zipf(1.3, random.integers(0, 40)))) for k in range(150)] + [(150, "only"), (151, None)]
    texts = spark.createDataFrame(rows, "k bigint, t string")
    stored, durable = {}, pairs.durable

    def kept(df, name):
        stored[name] = durable(df, name)
        stored[name + " plan"] = df._jdf.queryExecution().executedPlan().toString()
        return stored[name]

    monkeypatch.setattr(pairs, "durable", kept)
    usual = sorted(map(tuple, content.similar_texts(content.tfidf(texts, "k", "t", []), "k").collect()))
    stored.clear()
    numbered = content.tfidf(texts, "k", "t", [], numbered=True)
    assert sorted(map(tuple, content.similar_texts(numbered, "k").collect())) == usual and len(usual) > 500
    assert "vectors" not in stored and "hashpartitioning(token_id" not in stored["packed plan"]
    weights = {(r.k, r.token_id): r.weight for r in numbered.collect()}
    bundles = stored["packed"].collect()
    assert sum(r.entries for r in bundles) == len(weights)
    for r in bundles:
        keys, sizes, dims, found = pairs._opened(r.bundle)
        assert [weights[k, d] for k, d in zip(np.repeat(keys, sizes).tolist(), dims.tolist())] == found.tolist()
