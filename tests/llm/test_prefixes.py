import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tillroll.llm.prefixes import NODE, conversation_trie, prefix_trie, rebuilt

NAMES = [c.split()[0] for c in NODE.split(", ")]


def fold(rows, heads=4, family=20):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % family) * (1 if c > 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    rows, sums = [], {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        own = [sums[k] for k in kids.get(path, [])]
        sums[path] = (sum(k[0] for k in own) or 1, (len(members[path]) - 1) * words + sum(k[1] for k in own))
        ends = ",".join(map(str, sorted(c for c in members[path] if len(convs[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        rows.append(
            (min(members[path]), len(path), parent, len(members[path]), len(own), *sums[path], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(rows, key=repr)


def talk(seed, n=150):
    """Conversations that share turns, some of them equal, some very long, some with null or repeated turns."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 600), n):
        for t in range(rng.choice([1, 1, 2, 3, 4, 7])):
            rows.append((c, rng.choice([t, t, None, 3]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b c", "", None, "é  \n x", "a"])))
    for c in (701, 702, 703, 741, 742):
        for t in range(17):
            rows.append((c, t, "user", "same" if t < 12 or c < 703 else f"own {c}"))
    rows += [(c, t, "user", f"hot {t}") for c in range(1000, 1090) for t in range(3)]
    rows += [(None, 0, "user", "nobody"), rows[0], rows[0]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, chunk, container", [(1, 256, 4096), (2, 5, 3)])
def test_equals_brute_force(spark, seed, chunk, container):
    rows = talk(seed, 150 if seed == 1 else 40)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    convs, turns = rebuilt(frame)
    got = sorted((tuple(r) for r in prefix_trie(convs, turns, chunk, container).select(*NAMES).collect()), key=repr)
    assert got == brute(fold(rows))


def test_no_and_turnless_conversations(spark):
    nothing = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_trie(nothing).count() == 0
    rows = [(c, 0, "user", "x") for c in range(1, 20)]  # no conversation 0: those that drop their first turn have none
    got = conversation_trie(spark.createDataFrame(rows, nothing.schema)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(fold(rows)) and len(got) == 2


def test_clashing_columns(spark):
    rows = [(c, t, "user", f"x {t}") for c in (1, 2, 25) for t in range(4)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    extra = frame.withColumns({n: F.lit(7) for n in ("pos", "id", "words", "place", "chunk", "start", "n_turns", "container")})
    assert sorted(map(tuple, conversation_trie(extra).collect()), key=repr) == brute(fold(rows))
