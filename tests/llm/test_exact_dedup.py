import hashlib
from collections import defaultdict

import pytest

from tillroll.llm.exact_dedup import ContentTable, drop_copies, exact_dedup, grace_groups


def expected(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[text or ""].append(doc)
    return groups


@pytest.mark.parametrize("limit", [64 << 20, 300])
def test_groups_of_odd_rows(spark, odd, limit):
    groups = expected(odd.collect())
    got = exact_dedup(odd, limit).collect()
    assert len(got) == odd.count()
    for text, docs in groups.items():
        mine = [r for r in got if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        assert {r.group_size for r in mine} == {len(docs)} and sum(r.kept for r in mine) == 1
        assert {r.keep_id for r in mine} == {max((d for d in docs if d is not None), default=None)}
    assert drop_copies(odd, limit).count() == len(groups) and drop_copies(odd).columns == odd.columns


def test_no_rows(empty):
    assert exact_dedup(empty).count() == 0


@pytest.mark.parametrize("limit", [1, 200, 5_000, 10**9])
def test_spill_files_give_the_same_groups(limit):
    texts = [b"%d" % (i % 700) * (1 + i % 5) for i in range(5000)]
    rows = [(hashlib.sha256(t).digest(), t, i, 1) for i, t in enumerate(texts)]
    got = {text: (doc, n) for _, text, doc, n in grace_groups(rows, limit)}
    assert got == {t: (max(i for i, u in enumerate(texts) if u == t), texts.count(t)) for t in set(texts)}


def test_equal_digests_are_no_proof():
    table = ContentTable()
    for text in (b"a", b"b", b"a"):
        table.add(b"\0" * 32, text, 1, 1)
    assert sorted(table.rows) == [1, 2]
    # a bucket that no digit can split stays in memory
    assert len(list(grace_groups([(b"\0" * 32, b"%d" % i, i, 1) for i in range(50)], 1))) == 50
