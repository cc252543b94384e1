"""Personal data: fixed patterns, and terms that give protected entities away, in DataFrame functions only.

Values found by the patterns are the protected entities.  The words around each mention are its context.  A term that
comes with an entity in several different contexts is weighed by the corpus: its pointwise mutual information with the
entity over the entity's own information is the share of the entity that the term discloses.  Above one threshold the
term is removed from the texts that mention the entity, above a lower one it is generalised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored

# fixed values: kinds in the order of reports
KINDS = ["email", "ip", "card", "phone", "term"]
#: The patterns, written so that a long run of their characters is tried once: a match begins where a run begins, or
#: where the match before ended, and repeats don't give back what the next part can't use.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Code points of context on each side of a mention, and letters of a term at least.
CONTEXT, LETTERS = 80, 4
#: A term and an entity must meet in so many different contexts.
CONTEXTS = 3
#: Shares of an entity's information that a term may disclose before it is generalised, or removed.
GENERALISE, REMOVE = 0.5, 0.8

_SPANS = "array<struct<start:long,kind:int,end:long>>"
_DIGITS = "regexp_replace(s.value, '[^0-9]', '')"
_ACCEPTED = {
    "email": "true",
    "ip": "forall(split(s.value, '[.]'), p -> length(trim(LEADING '0' FROM p)) < 3 "
    "OR (length(trim(LEADING '0' FROM p)) = 3 AND trim(LEADING '0' FROM p) <= '255'))",
    "card": f"length({_DIGITS}) BETWEEN 14 AND 19 AND aggregate(sequence(1, length({_DIGITS})), 0L, (n, i) -> n + "
    f"CASE WHEN i % 2 = 1 THEN cast(substr({_DIGITS}, -i, 1) AS int) "
    f"ELSE (2 * cast(substr({_DIGITS}, -i, 1) AS int)) % 10 + (2 * cast(substr({_DIGITS}, -i, 1) AS int)) DIV 10 END) % 10 = 0",
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
}


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def placed(text: str, pattern: str, kind: int) -> str:
    """SQL for the matches of ``pattern`` as structs of start, kind, end and value; positions from what lies between."""
    return f"""aggregate(
        arrays_zip(slice(split({text}, {pattern}, -1), 1, size(regexp_extract_all({text}, {pattern}, 0))),
                   regexp_extract_all({text}, {pattern}, 0)),
        named_struct('at', 0L, 'spans', cast(array() AS array<struct<start:long,kind:int,end:long,value:string>>)),
        (a, m) -> named_struct(
            'at', a.at + length(m.`0`) + length(m.`1`),
            'spans', concat(a.spans, array(named_struct('start', a.at + length(m.`0`), 'kind', {kind},
                                                        'end', a.at + length(m.`0`) + length(m.`1`), 'value', m.`1`)))),
        a -> a.spans)"""


def mentioned(docs: DataFrame) -> DataFrame:
    """doc_id, text, base: the accepted matches of the fixed patterns by start and kind, with their values."""
    empty = "cast(array() AS array<struct<start:long,kind:int,end:long,value:string>>)"
    texts = docs.selectExpr("cast(doc_id AS long) AS doc_id", "coalesce(text, '') AS text")
    # every pattern needs an @ or a digit
    tests = dict.fromkeys(PATTERNS, "text RLIKE '[0-9]'") | {"email": "contains(text, '@')"}
    spans = texts.selectExpr(
        "*",
        *[
            f"if({tests[kind]}, filter({placed('text', quoted(pattern), i)}, s -> {_ACCEPTED[kind]}), {empty}) AS {kind}"
            for i, (kind, pattern) in enumerate(PATTERNS.items())
        ],
    )
    return spans.selectExpr("doc_id", "text", f"array_sort(concat({', '.join(PATTERNS)})) AS base")


def disclosures(rows: DataFrame, docs: DataFrame, contexts: int = CONTEXTS) -> DataFrame | None:
    """entity, term, share: pairs that meet in enough contexts and the share of the entity that the term discloses.

    ``rows`` has base spans with text where there are any.  Repeated contexts, as in copies, count once.  None if no
    pair meets often enough.
    """
    context = (
        f"concat(substr(text, greatest(1, s.start + 1 - {CONTEXT}), least(s.start, {CONTEXT})), ' ', substr(text, s.end + 1, {CONTEXT}))"
    )
    mentions = rows.filter("size(base) > 0").selectExpr(
        f"inline(transform(base, s -> struct(concat(s.kind, ':', s.value) AS entity, lower({context}) AS context)))"
    ).distinct()
    pairs = (
        mentions.selectExpr("entity", f"explode(array_distinct(regexp_extract_all(context, '\\\\p{{L}}{{{LETTERS},}}', 0))) AS term")
        .groupBy("entity", "term").agg(F.count("*").alias("met")).filter(F.col("met") >= contexts)
    )
    pairs = stored(pairs, "pii-pairs")
    if pairs.isEmpty():
        return None
    per_entity = mentions.groupBy("entity").agg(F.count("*").alias("mentions"))
    per_term = (
        docs.selectExpr(f"explode(array_distinct(regexp_extract_all(lower(text), '\\\\p{{L}}{{{LETTERS},}}', 0))) AS term")
        .groupBy("term").agg(F.count("*").alias("texts"))
    )
    n = float(docs.count())
    shares = f"log2(met * {n} / (cast(mentions AS double) * greatest(texts, met))) / log2({n} / mentions)"
    return (
        pairs.join(per_entity, "entity").join(per_term, "term").filter(f"mentions < {n}")
        .select("entity", "term", F.expr(shares).alias("share"))
    )


def personal_data(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, contexts: int = CONTEXTS) -> DataFrame:
    """Spans of personal data in every whole text, in code points, ends exclusive, and what to do with them.

    ``docs`` needs doc_id and text; other columns are ignored.  A null text counts as empty.  Returns a row per row,
    repeated ones too: doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans, n_term, and safe_text, the text with
    base values and removed terms replaced by their kind and generalised terms by their first letter; null where
    nothing was found.
    """
    rows = stored(mentioned(docs).selectExpr("doc_id", "if(size(base) > 0, text, NULL) AS text", "base"), "pii-base")
    pairs = disclosures(rows, docs, contexts)
    plain = rows.withColumn("added", F.expr(f"cast(array() AS {_SPANS})"))
    if pairs is not None:
        told = stored(pairs.filter(F.col("share") >= generalise), "pii-terms")
        holders = rows.filter("size(base) > 0").withColumn("mark", F.sha2(F.concat_ws("|", "doc_id", "text"), 256))
        by_row = (
            holders.selectExpr("mark", "explode(transform(base, s -> concat(s.kind, ':', s.value))) AS entity").distinct()
            .join(told, "entity").groupBy("mark", "term").agg(F.max("share").alias("share"))
            .groupBy("mark").agg(F.concat_ws("|", F.sort_array(F.collect_list("term"))).alias("terms"),
                                 F.concat_ws("|", F.sort_array(F.collect_list(F.when(F.col("share") >= remove, F.col("term"))))).alias("gone"))
        )
        # the pattern differs by row
        searched = holders.join(by_row, "mark", "left").withColumn("pattern", F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), "terms", F.lit(r")(?!\p{L})")))
        found = searched.withColumn("hits", F.expr(f"if(terms IS NULL, cast(array() AS array<struct<start:long,kind:int,end:long,value:string>>), {placed('text', 'pattern', 4)})"))
        apart = "filter(hits, t -> NOT exists(base, b -> b.start < t.end AND t.start < b.end))"
        kind = "if(array_contains(split(gone, '[|]'), lower(t.value)), 4, 5)"
        done = found.withColumn("added", F.expr(f"transform({apart}, t -> named_struct('start', t.start, 'kind', {kind}, 'end', t.end))"))
        plain = plain.filter("size(base) = 0").unionByName(done.select("doc_id", "text", "base", "added"))
    names = ",".join(f"'{k}'" for k in [*KINDS, "term"])
    said = "array_join(transform({0}, s -> concat_ws(':', array({1})[s.kind], s.start, s.end)), ',')"
    bare = f"transform(base, s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end))"
    every = plain.withColumn("every", F.expr(f"array_sort(concat({bare}, added))"))
    safe = f"""aggregate(every, named_struct('at', 0L, 'out', ''), (a, s) -> if(s.start < a.at, a, named_struct(
        'at', s.end, 'out', concat(a.out, substr(text, cast(a.at + 1 AS int), cast(s.start - a.at AS int)),
            if(s.kind = 5, concat(substr(text, cast(s.start + 1 AS int), 1), '.'), concat('[', array({names})[s.kind], ']'))))),
        a -> concat(a.out, substr(text, cast(a.at + 1 AS int))))"""
    return every.selectExpr(
        "doc_id",
        *[f"cast(size(filter(base, s -> s.kind = {i})) AS long) AS n_{k}" for i, k in enumerate(KINDS[:4])],
        said.format("base", names) + " AS base_spans",
        said.format("every", names) + " AS spans",
        "cast(size(added) AS long) AS n_term",
        f"if(size(every) > 0, {safe}, NULL) AS safe_text",
    )
