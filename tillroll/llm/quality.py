"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Basic counts are taken of every text.  Texts that pass the base go through the rules; each rule's cost and share of
rejections are measured on a sample, and the rules are asked in order of rejections per cost, the rest of a rejected
text's rules never.  The order changes the time, not the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored

#: Rows of the sample on which rules are measured, about.
SAMPLE = 2_000
SPACE = r"' \t\n\u000b\u000c\r'"


@dataclass(frozen=True)
class Rule:
    """A text is rejected where ``reject``, SQL on text and the basic counts, is true."""

    name: str
    reject: str


RULES = (
    Rule("symbols", "n_symbols > 0.1 * n_words"),
    Rule("duplicate lines", "n_dup_lines > 2 AND n_dup_lines > 0.3 * n_lines"),
    Rule("repeated words", "4 * n_repeat_words > n_words"),
    Rule("word length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("few different words", "10 * size(array_distinct(words)) < n_words"),
    Rule("capitals", r"length(regexp_replace(text, '[^\\p{Lu}]+', '')) > 0.4 * word_chars"),
    Rule("exclamations", "5 * regexp_count(text, '!') > 2 * n_words"),
    Rule("letters", r"2 * length(regexp_replace(text, '[^\\p{L}]+', '')) < word_chars"),
)


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with words, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    A step's columns are used several times by the next, so each is a projection of its own.  Lambdas read only their
    own elements: a filter on a count puts the steps' expressions into one another, and a column that a lambda reads
    from outside would be computed anew for each element.
    """
    step = docs.selectExpr("cast(doc_id AS long) AS doc_id", "coalesce(text, '') AS text")
    step = step.selectExpr("*", f"trim(BOTH {SPACE} FROM text) AS bare")
    step = step.selectExpr(
        "doc_id",
        "text",
        r"if(bare = '', cast(array() AS array<string>), split(bare, '[\\x20\\x09-\\x0D]+')) AS words",
        rf"filter(split(text, '\n'), l -> trim(BOTH {SPACE} FROM l) <> '') AS lines",
    )
    step = step.selectExpr(
        "doc_id",
        "text",
        "words",
        "size(words) AS n_words",
        "length(array_join(words, '')) AS word_chars",
        "regexp_count(text, '[#*$%&|<>]') AS n_symbols",
        "size(lines) AS n_lines",
        "size(lines) - size(array_distinct(lines)) AS n_dup_lines",
        "if(size(words) < 3, cast(array() AS array<string>), transform(slice(arrays_zip(words, slice(words, 2, size(words)), "
        "slice(words, 3, size(words))), 1, greatest(0, size(words) - 2)), z -> concat_ws(' ', z.words, z.`1`, z.`2`))) AS windows",
    )
    kept = [c for c in step.columns if c != "windows"]
    # only texts in which a window comes twice have their windows sorted
    step = step.selectExpr(
        *kept,
        "if(size(array_distinct(windows)) = size(windows), cast(array() AS array<struct<w:string,i:int>>), "
        "sort_array(transform(windows, (w, i) -> struct(w, i)))) AS ordered",
    )
    step = step.selectExpr(
        *kept,
        # each window beside the one before and the one after it in order
        "sort_array(transform(filter(arrays_zip(concat(array(named_struct('w', cast(NULL AS string), 'i', -1)), ordered), ordered, "
        "slice(ordered, 2, size(ordered))), z -> z.ordered IS NOT NULL AND (z.`0`.w <=> z.ordered.w OR z.`2`.w <=> z.ordered.w)), "
        "z -> z.ordered.i)) AS places",
    )
    return step.selectExpr(
        *kept,
        "aggregate(places, struct(0 AS n, -3 AS last), (a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last), a -> a.n) "
        "AS n_repeat_words",
    )


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def cascade_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> list[Rule]:
    """The rules by rejections per second on a sample of ``docs``, the most first."""
    rows = docs.count()
    if not rows:
        return list(rules)
    held = stored(counted(docs.sample(min(1.0, sample / rows), seed=7)), "quality-sample").filter(f"NOT ({BASE_FAILED})")

    def measured(reject: str) -> tuple[int, float]:
        began = time.perf_counter()
        n = held.agg(F.count_if(F.expr(reject))).first()[0]
        return n, time.perf_counter() - began

    measured("n_words < 0")
    _, nothing = measured("n_words < 0")
    rate = {}
    for rule in rules:
        rejected, seconds = measured(rule.reject)
        rate[rule] = rejected / max(1e-3, seconds - nothing)
    return sorted(rules, key=lambda r: -rate[r])


def quality(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> DataFrame:
    """Basic counts and verdict for every row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored.  A null or blank text has no words and fails the base.
    Repeated rows and null doc_ids get a row each.  Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and rejected_by: the first rule of the cascade to reject, "base", or null.  A
    text that several rules reject may name another of them in the next run, as the order is measured.
    """
    ordered = cascade_order(docs.select("doc_id", "text"), rules, sample)
    branches = " ".join(f"WHEN {r.reject} THEN '{r.name}'" for r in ordered)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = counted(docs).selectExpr(
        "doc_id", *[f"cast({c} AS long) AS {c}" for c in counts], f"CASE WHEN {BASE_FAILED} THEN 'base' {branches} END AS rejected_by"
    )
    return judged.selectExpr("*", "coalesce(rejected_by = 'base', false) AS base_failed", "rejected_by IS NULL AS kept")
