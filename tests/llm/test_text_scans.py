"""Quality rules, personal data, secrets, licenses and toxicity against plain Python."""

import random
import re
import string

import numpy as np
import pytest

from tillroll.llm.licenses import TEXTS, license_scan
from tillroll.llm.pii import personal_data
from tillroll.llm.quality import RULES, quality
from tillroll.llm.secrets import least_steps, levels_of, mask_secrets, randomness, scan, secrets
from tillroll.llm.toxicity import FactorizationMachine, drop_toxic, toxicity


def repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_quality_counts(spark, odd, empty):
    rng = random.Random(4)
    texts = [None, "", "\x0b\x0c", "a b c a b c", "the the the the", "x\n\nx\n x\nx", "#$ %& | <> * f\x0cf\tfff"]
    texts += [" ".join(rng.choices("a b c d e".split(), k=rng.randrange(60))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality(docs).collect():
        text = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeats(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text
        assert r.base_failed == (len(words) < 50 or 100 * want[4] > 50 * len(words))
    assert quality(odd).count() == odd.count() and quality(empty).count() == 0


def test_order_of_rules_does_not_change_verdicts(spark):
    texts = ["good words of many kinds " + " ".join(map(str, range(i, i + 60))) for i in range(5)] + ["A" * 5 + " ! " * 40 + "x y z " + " ".join(map(str, range(80)))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [sorted((r.doc_id, r.kept) for r in quality(docs, rules).collect()) for rules in (RULES, RULES[::-1])]
    assert got[0] == got[1]


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def pii_ok(kind, value):
    digits = [int(c) for c in value if c in string.digits]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def test_personal_data_spans(spark, odd, empty):
    rng = random.Random(6)
    texts = [None, "", "a@b.c_d@e.f", "4111 1111 1111 1111", "+1 (269) 555-3296", "1.2.3.4.5.6.7.8 001.2.3.256", "😀 x@y.zz"]
    texts += ["".join(rng.choices("ab@.0123456789+-() _é", k=rng.randrange(50))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in personal_data(docs).collect():
        found = [(m.start(), i, m.end()) for i, (k, p) in enumerate(PII) for m in re.finditer(p, texts[r.doc_id] or "") if pii_ok(k, m[0])]
        assert r.base_spans == ",".join(f"{PII[i][0]}:{a}:{b}" for a, i, b in sorted(found))
    assert personal_data(odd).count() == odd.count() and personal_data(empty).count() == 0


def test_terms_that_give_an_entity_away(spark):
    texts = ["joe@ex.com likes bananas and zebrafish here", "a zebrafish walks with joe@ex.com today", "their zebrafish saw joe@ex.com here"]
    texts += [f"people here like things number {'x' * i}" for i in range(60)]
    got = {r.doc_id: r for r in personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0].safe_text == "[email] likes bananas and [term] here" and got[2].n_term == 1 and got[10].spans == ""


def test_secrets_spans(spark, odd, empty):
    rng = random.Random(8)
    texts = [None, "", 'ToKen = "abc" password=12345 api_key: x1y2z3', "AKIA" + "A" * 16 + "AKIA", "x" + "0123456789abcdef" * 2]
    texts += ["".join(rng.choices(["token", "=", " ", '"', "AKIA", "ABCDEFGH12", "deadbeef01", "passwd", ":", "é"], k=rng.randrange(14))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)),
        ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+")),
    ]
    least = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    for r in secrets(docs).collect():
        found = [(m.start(), i, m.end()) for i, (k, p) in enumerate(kinds) for m in p.finditer(texts[r.doc_id] or "") if least[k](m)]
        assert r.base_spans == ",".join(f"{kinds[i][0]}:{a}:{b}" for a, i, b in sorted(found))
    assert secrets(odd).count() == odd.count() and secrets(empty).count() == 0
    assert mask_secrets(odd).columns == odd.columns


def test_random_strings_are_told_from_words(spark):
    rng = random.Random(9)
    keys = ["".join(rng.choices(string.ascii_letters + string.digits, k=40)) for _ in range(300)]
    words = ["".join(rng.choices(["the", "ing", "tion", "er", "and"], k=10)) for _ in range(300)]
    assert np.mean([randomness(k) > 0.05 for k in keys]) > 0.9 and np.mean([randomness(w) > 0.05 for w in words]) < 0.1
    docs = spark.createDataFrame([(i, f"see {k} and {w} here") for i, (k, w) in enumerate(zip(keys, words))], "doc_id long, text string")
    got = secrets(docs).collect()
    assert sum(r.n_random for r in got) > 250 and all(r.spans in ("", "random:4:44") for r in got)
    assert min(least_steps(scan(docs))) < 20
    kept = mask_secrets(docs).filter("text LIKE 'see [random] and %'").count()
    assert kept == sum(r.n_random for r in got)


def test_keys_are_found_among_many_slugs(spark):
    rng = random.Random(12)
    words = ["".join(rng.choices("aeiou", k=1)) + "".join(rng.choices("bdlmnrst", k=1)) + "".join(rng.choices("aeiounrst", k=rng.randrange(2, 6))) for _ in range(400)]
    slugs = ["-".join(rng.choices(words, k=rng.randrange(5, 12))) + f"-{rng.randrange(100)}" for _ in range(20_000)]
    keys = ["".join(rng.choices(string.ascii_letters + string.digits, k=rng.randrange(48, 65))) for _ in range(60)]
    texts = [f"the {' '.join(rng.choices(words, k=10))} {s} end" for s in slugs] + [f"see {k} here" for k in keys]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.n_random for r in secrets(docs).collect()}
    hits, false = sum(got[20_000 + i] for i in range(60)), sum(got[i] for i in range(20_000))
    assert hits >= 54 and false <= 0.1 * (hits + false), (hits, false)


def test_levels_of_decoys():
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    for code, size in ((0, 0), (3, 1), (9, 4)):
        levels = levels_of(code, size, words)
        assert levels == levels_of(code, size, words) and levels == sorted(levels) and all(0 < x <= 1 for x in levels)
    assert len(levels_of(9, 4, words)) > 12  # beyond what as many decoys can show


def test_licenses(spark, empty):
    rows = [
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."), (2, "a/b/x", "plain words of prose that say nothing"),
        (3, "a/b/c/LICENSE", "Released under the MIT License."), (4, "a/b/c/d/y", "other prose"), (5, "z", "x\nAll rights reserved.\ny z\nmore prose here\nand more"),
        (6, None, None), (7, "a/b/x", "the work is under the version of the code that is public and of general use to us all"),
    ]
    got = {r.doc_id: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert {d: (r.license, r.inherited) for d, r in got.items()} == {
        1: ("Apache-2.0", None), 2: (None, "Apache-2.0"), 3: ("MIT", None), 4: (None, "MIT"), 5: ("proprietary", None), 6: (None, None), 7: (None, "Apache-2.0"),
    }
    assert not got[5].is_license_file
    assert license_scan(empty.selectExpr("doc_id", "text", "text AS path")).count() == 0


@pytest.fixture(scope="module")
def insults(spark):
    rng = random.Random(10)
    rows = []
    for i in range(600):
        words = ["".join(rng.choices("abcdefg", k=4)) for _ in range(60)]
        bad = rng.random() < 0.2
        if bad:
            words[rng.randrange(60)] = rng.choice(["moronic", "loweiheit", "scum"])
        rows.append((i, " ".join(words), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_on_held_out_rows(insults):
    docs = insults.select("doc_id", "text")
    got = toxicity(docs, insults.select("doc_id", "toxic")).join(insults, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 600 and np.mean([r.predicted == r.toxic for r in held]) > 0.97
    assert drop_toxic(docs, insults).count() == sum(r.predicted == 0 for r in got)


def test_toxicity_learns_pairs():
    rng = np.random.default_rng(12)
    texts, labels = [], []
    for _ in range(3000):  # toxic only where 1 and 2 come together
        one, two = rng.random(2) < 0.5
        texts.append(np.unique([*([1] if one else []), *([2] if two else []), *rng.integers(10, 60, 5)]))
        labels.append(float(one and two))
    machine = FactorizationMachine.fit(texts, np.array(labels), evidence=0.0, epochs=20)
    alone = [machine.scores([np.array(x)])[0] for x in ([1], [2], [1, 2])]
    assert alone[0] < 0.5 and alone[1] < 0.5 and alone[2] > 0.7


def neutral_alone(n=8000):
    """Two terms that don't tell the label, while both or none of them make it likely."""
    rng = np.random.default_rng(3)
    one, two = rng.random((2, n)) < 0.5
    labels = (rng.random(n) < np.where(one == two, 0.9, 0.1)).astype(float)
    texts = [np.unique([*([1] if a else []), *([2] if b else []), *rng.integers(10, 60, 5)]) for a, b in zip(one, two)]
    return texts, labels, one, two


def test_toxicity_learns_terms_that_are_neutral_alone():
    texts, labels, one, two = neutral_alone()
    machine = FactorizationMachine.fit(texts[:6000], labels[:6000])  # the parameters of the query
    scores, same = machine.scores(texts[6000:]), (one == two)[6000:]
    assert scores[same].mean() > 0.7 and scores[~same].mean() < 0.3
    assert np.mean((scores > 0.5) == same) > 0.95


def test_scores_are_sums_over_pairs():
    texts, labels, *_ = neutral_alone(1500)
    machine = FactorizationMachine.fit(texts, labels, evidence=0.0)
    for text, score in zip(texts[:50], machine.scores(texts[:50])):
        total = 0.0
        for part in machine.parts:
            x = [int(np.flatnonzero(part.terms == t)[0]) for t in text if t in part.terms]
            total += part.bias + sum(part.weights[i] for i in x)
            total += sum(part.factors[i] @ part.factors[j] for n, i in enumerate(x) for j in x[:n]) / max(1, len(x))
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_toxicity_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (9, 0)], "doc_id long, toxic int")
    assert toxicity(odd, labels).count() == odd.count() and toxicity(empty, labels).count() == 0
    assert {r.score for r in toxicity(odd, labels.limit(0)).collect()} == {0.5}
    assert drop_toxic(odd, labels).columns == odd.columns


def test_license_headers_among_other_words(spark):
    headers = [
        ("proprietary", "Copyright 2024 Jane Doe. All rights reserved."), ("MIT", "Copyright (c) 2020 Foo. Released under the MIT License."),
        ("Apache-2.0", 'Copyright 2024 Jane Doe. All rights reserved.\nLicensed under the Apache License, Version 2.0 (the "License"); you may not use this file except'),
        ("GPL-3.0", "# This work is licensed under\n# the GNU General Public\n# License, version 3."),
        ("MIT", "some prose before " * 40 + "released under the MIT license and prose " + "behind it all " * 40),
    ]
    rows = [(i, f"d{i}/x", text) for i, (_, text) in enumerate(headers)]
    rows += [(100 + i, f"p{i}/x", "and the file of the copyright is under a version of this source\nplain prose about use") for i in range(30)]
    got = {r.doc_id: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert [got[i].license for i in range(len(headers))] == [name for name, _ in headers]
    assert got[3].n_license_lines == 3 and got[3].is_license_file and not got[4].is_license_file
    assert not any(got[100 + i].license for i in range(30))


def test_whole_license_texts(spark):
    mit = TEXTS["MIT"].replace("<year> <copyright holders>", "2021 Jane Doe and the frob authors")
    bsd = TEXTS["BSD-3-Clause"].replace("The Regents of the University of California", "2020, Some Company")
    rows = [(1, "m/LICENSE", mit), (2, "m/src/a", "prose"), (3, "g/COPYING", TEXTS["GPL-3.0"]), (4, "g/x", "more prose"), (5, "b/LICENSE", bsd)]
    rows += [(6, "a/LICENSE", TEXTS["Apache-2.0"][: TEXTS["Apache-2.0"].index("END OF TERMS")]), (7, "n/x", "words\nLicensed under CC BY-NC 4.0.\nmore prose and yet more of it")]
    rows += [(100 + i, f"p{i}/x", "the software is provided to any person for use\nplain prose about the terms of this work") for i in range(30)]
    got = {r.doc_id: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert {d: r.license for d, r in got.items() if r.license} == {1: "MIT", 3: "GPL-3.0", 5: "BSD-3-Clause", 6: "Apache-2.0", 7: "CC-BY-NC-4.0"}
    assert {d for d, r in got.items() if r.is_license_file} == {1, 3, 5, 6}
    assert (got[2].inherited, got[4].inherited) == ("MIT", "GPL-3.0")


def test_one_random_string_in_a_small_table(spark):
    rng = random.Random(21)
    key = "".join(rng.choices(string.ascii_letters + string.digits, k=40))
    plain = [f"see articles/2024/03/How-To-Read-The-{w}-Files-Of-This-Year and thisisaverylongwordofprose{w}" for w in ("first", "other", "data")]
    hexes = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(30)]
    texts = [f"key {key} end", *plain, *hexes]  # hex strings are covered by their pattern and don't count
    got = {r.doc_id: r for r in secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0].spans == "random:4:44" and not any(r.n_random for d, r in got.items() if d)
    assert min(least_steps(scan(spark.createDataFrame([(1, p) for p in plain], "doc_id long, text string")))) == 20


def test_random_strings_of_one_case_or_digits(spark):
    rng = random.Random(22)
    keys = [("".join(rng.choices(alphabet, k=n))) for alphabet, n in ((string.ascii_uppercase, 64), (string.ascii_lowercase, 64), (string.digits, 32)) for _ in range(10)]
    docs = spark.createDataFrame([(i, f"see {k} here") for i, k in enumerate(keys)], "doc_id long, text string")
    got = secrets(docs).collect()
    assert all(sum(r.n_random for r in got if r.doc_id // 10 == kind) >= 7 for kind in range(2))
    assert all(r.n_hex == 1 for r in got if r.doc_id // 10 == 2)  # digits are within the pattern of hex strings
