"""The queries of ``queries.py`` in plain SQL, for checking."""

from __future__ import annotations

from dataclasses import replace

from tillroll.operators.rfm import RFM
from tillroll.plans import queries as q
from tillroll.schema import ADMIN_KEYWORDS, ADMIN_STOCK_CODES, REPORT_WEEKDAYS, SEGMENT_NOTES

# The English stop words that Spark ships.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now could would
""".split()


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values: list[str]) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


CANCELLED = "(l_returnflag = 'R' AND l_linestatus = 'F')"
BAD_CODE = f"coalesce(stock_code IN {in_list(ADMIN_STOCK_CODES)} OR starts_with(stock_code, 'gift_'), false)"
BAD_TEXT = "(" + " OR ".join(f"contains(upper(description), {text(k)})" for k in ADMIN_KEYWORDS) + ")"
VOID = "coalesce(starts_with(invoice_no, 'C'), false)"
TIDY = "trim(upper(coalesce(description, 'nan')), ' ' || chr(9) || chr(10) || chr(13) || chr(160))"
LINE = "invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"
SHOWN = LINE.replace("invoice_date", "strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date")
MONTH = "strftime(invoice_date, '%Y-%m')"
SAMPLE_ORDER = (
    "md5(concat_ws('|', invoice_no, stock_code, quantity::VARCHAR, description, '42')), "
    "invoice_no, stock_code, quantity, description, unit_price"
)


def distance(centre, columns):
    return "(" + " + ".join(f"({c} - ({v})) * ({c} - ({v}))" for c, v in zip(columns, centre)) + ")"


Z = [f"z_{c}" for c in RFM]


def nearest(columns):
    d = [distance(c, columns) for c in q.GIVEN_CENTRES]
    low = "least(" + ", ".join(d) + ")"
    whens = " ".join(f"WHEN {e} = {low} THEN {i}" for i, e in enumerate(d))
    return f"CASE {whens} END"


def expected(horizon: int) -> str:
    """Expected purchases up to ``horizon`` from x, tx, t with the given parameters."""
    g = q.GIVEN_PURCHASE
    z = f"({horizon} / ({g.alpha} + t + {horizon}))"
    a_, b_, c_ = f"({g.r} + x)", f"({g.b} + x)", f"({g.a} + {g.b} + x - 1)"
    series = (
        f"list_sum(list_transform(range(0, 400), lambda k: exp(lgamma({a_} + k) - lgamma({a_}) + lgamma({b_} + k) "
        f"- lgamma({b_}) - lgamma({c_} + k) + lgamma({c_}) - lgamma(k + 1.0) + k * ln({z}))))"
    )
    stay = f"(({g.alpha} + t) / ({g.alpha} + t + {horizon}))"
    gone = (
        f"(CASE WHEN x > 0 THEN {g.a} / ({g.b} + greatest(x, 1) - 1) "
        f"* pow(({g.alpha} + t) / ({g.alpha} + tx), {a_}) ELSE 0 END)"
    )
    return f"({c_} / ({g.a} - 1) * (1 - {series} * pow({stay}, {a_})) / (1 + {gone}))"


def expected_integrated(horizon: int) -> str:
    """Expected purchases up to ``horizon`` by integrating over the dropout probability p, for a and b near 0.

    Given that a customer is active, p is Beta(a, b + x) and the purchase rate is Gamma; with p = 1 / (1 + exp(-s)) the
    trapezoid rule in s is exact to many digits.
    """
    g = q.LOW_DROPOUT
    p, rest = "(1 / (1 + exp(-s)))", "(1 / (1 + exp(s)))"
    u = f"({p} * {horizon} / ({g.alpha} + t))"
    power = f"(({g.r} + x) * CASE WHEN {u} < 1e-6 THEN {u} * (1 - {u} / 2) ELSE ln(1 + {u}) END)"
    bought = f"(CASE WHEN {power} < 1e-9 THEN {power} ELSE 1 - exp(-{power}) END / {p})"
    weight = f"(pow({p}, {g.a}) * pow({rest}, {g.b} + x))"
    area = f"(0.1 * list_sum(list_transform(range(-1000, 1001), lambda k: list_transform([k * 0.1], lambda s: {weight} * {bought})[1])))"
    norm = f"exp(lgamma({g.a}) + lgamma({g.b} + x) - lgamma({g.a} + {g.b} + x))"
    gone = f"(CASE WHEN x > 0 THEN {g.a} / ({g.b} + greatest(x, 1) - 1) * pow(({g.alpha} + t) / ({g.alpha} + tx), {g.r} + x) ELSE 0 END)"
    return f"({area} / {norm} / (1 + {gone}))"


def clv_value(expected=expected) -> str:
    v = q.GIVEN_VALUE
    flow = " + ".join(
        f"({expected(i)} - {expected(i - 1) if i > 1 else '0'}) / pow(1.01, {i})" for i in (1, 2, 3)
    )
    return f"(({v.p} * ({v.v} + x * monetary_value) / ({v.p} * x + {v.q} - 1)) * ({flow}))"


# Named parts: (parts it needs, SQL).
PARTS: dict[str, tuple[str, str]] = {
    "once": (
        "",
        f"""SELECT l_orderkey,
            CASE WHEN {CANCELLED} THEN 'C' ELSE '' END || l_orderkey::VARCHAR AS invoice_no,
            CASE l_partkey % 50 WHEN 0 THEN 'POST' WHEN 1 THEN 'gift_' || l_partkey::VARCHAR
                ELSE l_partkey::VARCHAR END AS stock_code,
            CASE WHEN l_partkey % 61 = 0 THEN NULL WHEN l_partkey % 67 = 0 THEN p_name || ' damaged??'
                ELSE '  ' || p_name || ' ' || p_brand || ' ' || p_type || chr(9) END AS description,
            CASE WHEN {CANCELLED} OR l_orderkey % 97 = 0 THEN -l_quantity::INTEGER
                ELSE l_quantity::INTEGER END AS quantity,
            o_orderdate + to_hours(6 + o_orderkey % 14) + to_minutes(o_orderkey % 60) AS invoice_date,
            CASE WHEN l_partkey % 101 = 0 THEN 0.0 ELSE l_extendedprice / l_quantity / 1000 END AS unit_price,
            CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_custkey::DOUBLE END AS customer_id,
            n_name AS country
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    ),
    "sales": (
        "once",
        f"SELECT {LINE} FROM once UNION ALL SELECT {LINE} FROM once WHERE l_orderkey % 40 = 10",
    ),
    "pre": (
        "sales",
        f"SELECT DISTINCT {LINE.replace('customer_id', 'customer_id::BIGINT AS customer_id')} FROM sales "
        "WHERE customer_id IS NOT NULL",
    ),
    "tidy": ("pre", f"SELECT {LINE.replace('description', TIDY + ' AS description')} FROM pre"),
    "cleaned": (
        "tidy",
        f"SELECT *, quantity * unit_price AS total_amount FROM tidy WHERE NOT {BAD_CODE} AND NOT {BAD_TEXT} AND NOT {VOID}",
    ),
    "purchases": ("cleaned", "SELECT * FROM cleaned WHERE quantity > 0 AND unit_price > 0"),
    "rfm": (
        "purchases",
        """SELECT customer_id,
            datediff('day', TIMESTAMP '1970-01-01', TIMESTAMP '1970-01-01'
                + to_seconds(epoch((SELECT max(invoice_date) FROM purchases))::BIGINT - epoch(max(invoice_date))::BIGINT)) AS recency,
            count(DISTINCT invoice_no) AS frequency, sum(total_amount) AS monetary
        FROM purchases GROUP BY customer_id HAVING sum(total_amount) > 0""",
    ),
    "rfm_cleaned": (
        "cleaned",
        """SELECT customer_id,
            (epoch((SELECT max(invoice_date) FROM cleaned))::BIGINT - epoch(max(invoice_date))::BIGINT) // 86400 AS recency,
            count(DISTINCT invoice_no) AS frequency, sum(total_amount) AS monetary
        FROM cleaned GROUP BY customer_id""",
    ),
    "ratio": (
        "pre",
        """SELECT customer_id,
            count(DISTINCT CASE WHEN quantity < 0 THEN invoice_no END) / count(DISTINCT invoice_no) AS return_ratio
        FROM pre GROUP BY customer_id""",
    ),
    "full_rfm": (
        "rfm ratio",
        """SELECT rfm.*, coalesce(return_ratio, 0.0) AS return_ratio FROM rfm LEFT JOIN ratio USING (customer_id)""",
    ),
    "capped": (
        "full_rfm",
        "SELECT customer_id, "
        + ", ".join(
            f"least({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.995) FROM full_rfm)) AS {c}" for c in RFM
        )
        + ", return_ratio FROM full_rfm",
    ),
    "scaled": (
        "capped",
        "SELECT *, "
        + ", ".join(
            f"(ln(1 + {c}) - (SELECT avg(ln(1 + {c})) FROM capped)) / (SELECT stddev_pop(ln(1 + {c})) FROM capped) AS z_{c}"
            for c in RFM
        )
        + " FROM capped",
    ),
    "assigned": ("scaled", f"SELECT *, {nearest(Z)}::INTEGER AS cluster FROM scaled"),
    "profiles": (
        "assigned",
        "SELECT cluster, avg(recency) AS recency, avg(frequency) AS frequency, avg(monetary) AS monetary, "
        "avg(return_ratio) AS return_ratio FROM assigned GROUP BY cluster",
    ),
    "places": ("profiles", "SELECT *, row_number() OVER (ORDER BY monetary, cluster) AS place FROM profiles"),
    "labels": (
        "places",
        """SELECT cluster, CASE place WHEN 4 THEN 'High-Value' WHEN 3 THEN 'Regular'
            ELSE CASE WHEN (place = 1) = ((SELECT recency FROM places WHERE place = 1)
                > (SELECT recency FROM places WHERE place = 2)) THEN 'At-Risk' ELSE 'Occasional' END END AS segment
        FROM places""",
    ),
    "segmented": ("assigned labels", "SELECT assigned.*, segment FROM assigned JOIN labels USING (cluster)"),
    "days": (
        "purchases",
        "SELECT customer_id, invoice_date::DATE AS day, sum(total_amount) AS total FROM purchases GROUP BY ALL",
    ),
    "summary": (
        "days",
        """SELECT customer_id, count(*) - 1 AS x, datediff('day', min(day), max(day)) / 30.0::DOUBLE AS tx,
            datediff('day', min(day), (SELECT max(day) FROM days)) / 30.0::DOUBLE AS t,
            CASE WHEN count(*) > 1 THEN (sum(total) - arg_min(total, day)) / (count(*) - 1) ELSE 0.0 END AS monetary_value
        FROM days GROUP BY customer_id""",
    ),
    "valued": (
        "summary",
        f"SELECT *, {expected(1)} AS expected_purchases, {clv_value()} AS predicted_clv FROM summary",
    ),
    "item_lines": ("purchases", "SELECT description, count(*) AS n_lines FROM purchases GROUP BY description"),
    "bought": (
        "purchases item_lines",
        """SELECT DISTINCT description, customer_id FROM purchases
        WHERE description IN (SELECT description FROM item_lines WHERE n_lines >= 5)""",
    ),
    "buyers": ("bought", "SELECT description, count(*) AS n FROM bought GROUP BY description"),
    "cosine": (
        "bought buyers",
        """SELECT item_a, item_b, common, common / sqrt(na.n::DOUBLE * nb.n::DOUBLE) AS similarity
        FROM (SELECT a.description AS item_a, b.description AS item_b, count(*) AS common
              FROM bought a JOIN bought b ON a.customer_id = b.customer_id AND a.description <> b.description GROUP BY ALL) p
        JOIN buyers na ON na.description = item_a JOIN buyers nb ON nb.description = item_b""",
    ),
    "item_recs": (
        "cosine",
        """SELECT * FROM (SELECT item_a AS description,
            row_number() OVER (PARTITION BY item_a ORDER BY similarity DESC, item_b) AS rank,
            item_b AS item, similarity AS score FROM cosine) WHERE rank <= 5""",
    ),
    "best": (
        "item_lines",
        """SELECT row_number() OVER (ORDER BY n_lines DESC, description) AS rank, description AS item, n_lines
        FROM item_lines ORDER BY n_lines DESC, description LIMIT 5""",
    ),
    "held": (
        "purchases item_lines",
        """SELECT DISTINCT invoice_no, description FROM purchases
        WHERE description IN (SELECT description FROM item_lines WHERE n_lines >= 5)""",
    ),
    "support": ("held", "SELECT description, count(*) AS n FROM held GROUP BY description"),
    "rules": (
        "held support",
        """SELECT item_a, item_b, co_occurrences, sa.n AS support_a, sb.n AS support_b,
            co_occurrences / sa.n AS confidence,
            co_occurrences::DOUBLE * (SELECT count(DISTINCT invoice_no) FROM held) / (sa.n::DOUBLE * sb.n::DOUBLE) AS lift
        FROM (SELECT a.description AS item_a, b.description AS item_b, count(*) AS co_occurrences
              FROM held a JOIN held b ON a.invoice_no = b.invoice_no AND a.description <> b.description
              GROUP BY ALL HAVING count(*) >= 3) p
        JOIN support sa ON sa.description = item_a JOIN support sb ON sb.description = item_b""",
    ),
    "user_items": (
        "purchases item_lines",
        """SELECT DISTINCT customer_id, description FROM purchases
        WHERE description IN (SELECT description FROM item_lines WHERE n_lines >= 3)""",
    ),
    "user_sizes": ("user_items", "SELECT customer_id, count(*) AS n FROM user_items GROUP BY customer_id"),
    "neighbors": (
        "user_items user_sizes",
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                ORDER BY round(similarity, 9) DESC, neighbor) AS rank
            FROM (SELECT customer_id, neighbor, common / sqrt(na.n::DOUBLE * nb.n::DOUBLE) AS similarity
                FROM (SELECT a.customer_id, b.customer_id AS neighbor, count(*) AS common
                      FROM user_items a JOIN user_items b
                        ON a.description = b.description AND a.customer_id <> b.customer_id GROUP BY ALL) p
                JOIN user_sizes na USING (customer_id) JOIN user_sizes nb ON nb.customer_id = neighbor)) WHERE rank <= 5""",
    ),
    "user_recs": (
        "user_items neighbors",
        """SELECT customer_id, rank, item, round(share, 2) AS score FROM (
            SELECT customer_id, o.description AS item, share,
                row_number() OVER (PARTITION BY customer_id ORDER BY share DESC, o.description) AS rank
            FROM (SELECT n.customer_id, u.description, count(*) / any_value(k.k) AS share
                  FROM neighbors n JOIN user_items u ON u.customer_id = n.neighbor
                  JOIN (SELECT customer_id, count(*) AS k FROM neighbors GROUP BY ALL) k ON k.customer_id = n.customer_id
                  GROUP BY ALL) o
            ANTI JOIN user_items own USING (customer_id, description)) WHERE rank <= 5""",
    ),
}


def tfidf_parts(prefix: str, needs: str, key: str, source: str, value: str) -> None:
    stop = in_list(STOP_WORDS)
    PARTS[f"{prefix}_texts"] = (needs, source)
    PARTS[f"{prefix}_tf"] = (
        f"{prefix}_texts",
        f"""SELECT {key}, token, count(*) AS tf FROM (
            SELECT {key}, unnest(regexp_extract_all(lower({value}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS token FROM {prefix}_texts)
        WHERE token NOT IN {stop} GROUP BY ALL""",
    )
    PARTS[f"{prefix}_df"] = (f"{prefix}_tf", f"SELECT token, count(*) AS df FROM {prefix}_tf GROUP BY token")
    PARTS[f"{prefix}_raw"] = (
        f"{prefix}_tf {prefix}_df",
        f"""SELECT *, tf * (ln((1 + (SELECT count(*) FROM {prefix}_texts)) / (1 + df)) + 1) AS raw
        FROM {prefix}_tf JOIN {prefix}_df USING (token)""",
    )
    PARTS[f"{prefix}_weights"] = (
        f"{prefix}_raw",
        f"""SELECT {key}, token, tf, df, raw / length AS weight FROM {prefix}_raw
        JOIN (SELECT {key}, sqrt(sum(raw * raw)) AS length FROM {prefix}_raw GROUP BY {key}) USING ({key})""",
    )
    PARTS[f"{prefix}_near"] = (
        f"{prefix}_weights",
        f"""SELECT {key}, rank, item, round(round(s, 9) * 100, 1) AS score FROM (
            SELECT {key}, item, s, row_number() OVER (PARTITION BY {key} ORDER BY round(s, 9) DESC, item) AS rank
            FROM (SELECT a.{key}, b.{key} AS item, sum(a.weight * b.weight) AS s
                  FROM {prefix}_weights a JOIN {prefix}_weights b ON a.token = b.token AND a.{key} <> b.{key} GROUP BY ALL))
        WHERE rank <= 5""",
    )


tfidf_parts("desc", "purchases", "description", "SELECT DISTINCT description FROM purchases", "description")
tfidf_parts("doc", "", "doc_id", "SELECT doc_id, text FROM documents", "text")


def sql(needs: str, body: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for n in PARTS[name][0].split():
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs.split():
        visit(n)
    head = ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in order)
    return f"WITH {head}\n{body}" if order else body


def rounded(columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns.split())


def histogram(needs: str, source: str, series: dict[str, tuple[str, str]], bins: int = 50) -> str:
    """``series`` maps a name to (value, condition)."""
    parts = []
    for name, (value, condition) in series.items():
        parts.append(
            f"""SELECT '{name}' AS series, g.bin::INTEGER AS bin, round(lo + g.bin * ((hi - lo) / {bins}), 6) AS bin_start,
                round(lo + (g.bin + 1) * ((hi - lo) / {bins}), 6) AS bin_end, coalesce(n, 0) AS n
            FROM (SELECT unnest(range(0, {bins})) AS bin) g,
                (SELECT min(({value})::DOUBLE) AS lo, max(({value})::DOUBLE) AS hi FROM {source} WHERE {condition}) r
            LEFT JOIN (SELECT least(floor((({value})::DOUBLE - lo) / ((hi - lo) / {bins})), {bins - 1})::INTEGER AS b, count(*) AS n
                FROM {source}, (SELECT min(({value})::DOUBLE) AS lo, max(({value})::DOUBLE) AS hi FROM {source} WHERE {condition})
                WHERE {condition} GROUP BY ALL) c ON c.b = g.bin"""
        )
    return sql(needs, "\nUNION ALL\n".join(parts))


def density(needs: str, source: str, columns: list[str], points: int = 200) -> str:
    parts = [
        f"""SELECT '{c}' AS series, point::INTEGER AS point, round(any_value(x), 6) AS x,
            round(sum(exp(-0.5 * pow((x - v) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 6) AS density
        FROM (SELECT ({c})::DOUBLE AS v FROM {source}),
            (SELECT point, lo + point * ((hi - lo) / {points - 1}) AS x, h, n
             FROM (SELECT unnest(range(0, {points})) AS point),
                  (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi, count(*) AS n,
                          stddev_samp({c}) * pow(count(*), -0.2) AS h FROM {source}))
        GROUP BY point"""
        for c in columns
    ]
    return sql(needs, "\nUNION ALL\n".join(parts))


def profile(needs: str, source: str, columns: list[str]) -> str:
    return sql(
        needs,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS non_null, count(*) - count({c}) AS nulls, round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, round(min({c})::DOUBLE, 6) AS min,
            round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50,
            round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, round(max({c})::DOUBLE, 6) AS max FROM {source}"""
            for c in columns
        ),
    )


def lower_beta(y: str, a: str, b: str) -> str:
    """I_y(a, b) by its power series, for y that is not close to 1."""
    return (
        f"(exp({a} * ln({y}) + {b} * ln(1 - {y}) - lgamma({a}) - lgamma({b}) + lgamma({a} + {b})) / {a} * list_sum("
        f"list_transform(range(0, 400), lambda k: exp(lgamma({a} + {b} + k) - lgamma({a} + {b}) - lgamma({a} + 1 + k) "
        f"+ lgamma({a} + 1) + k * ln({y})))))"
    )


def t_tail(source: str, shown: str) -> str:
    """Adds the two-sided p-value to columns t and df; far tails are 0."""
    p = (
        "CASE WHEN abs(t) > 9 AND df > 100 THEN 0.0 ELSE 1 - "
        + lower_beta("(t * t / (df + t * t))", "0.5", "(df / 2)")
        + " END"
    )
    return f"""SELECT {shown}, round(p, 6) AS p_value, CASE WHEN p < 0.05 THEN 'reject' ELSE 'fail to reject' END AS decision
        FROM (SELECT *, {p} AS p FROM ({source}))"""


def welch(source: str) -> str:
    home = f"country = '{q.UK}'"
    stats = f"""SELECT count(*) FILTER ({home}) AS n1, count(*) FILTER (NOT {home}) AS n2,
        avg(total_amount) FILTER ({home}) AS m1, avg(total_amount) FILTER (NOT {home}) AS m2,
        var_samp(total_amount) FILTER ({home}) / n1 AS e1, var_samp(total_amount) FILTER (NOT {home}) / n2 AS e2 FROM {source}"""
    inner = f"""SELECT n1, n2, (m1 - m2) / sqrt(e1 + e2) AS t,
        pow(e1 + e2, 2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)) AS df FROM ({stats})"""
    return sql(source, t_tail(inner, "n1, n2, round(t, 6) AS t, round(df, 6) AS df"))


def pearson(needs: str, source: str) -> str:
    inner = f"""SELECT n, r, r * sqrt((n - 2) / (1 - r * r)) AS t, (n - 2)::DOUBLE AS df
        FROM (SELECT count(*) AS n, corr(quantity, unit_price) AS r FROM {source})"""
    return sql(needs, t_tail(inner, "n, round(r, 6) AS r, round(t, 6) AS t"))


def anova(source: str) -> str:
    groups = f"""SELECT dayname(invoice_date) AS d, count(*) AS n, avg(total_amount) AS m, var_pop(total_amount) AS v
        FROM {source} GROUP BY ALL"""
    sums = f"""SELECT (count(*) - 1)::DOUBLE AS df_between, (sum(n) - count(*))::DOUBLE AS df_within,
        sum(n * pow(m - (SELECT avg(total_amount) FROM {source}), 2)) AS ss_between, sum(n * v) AS ss_within FROM ({groups})"""
    inner = f"SELECT *, (ss_between / df_between) / (ss_within / df_within) AS f FROM ({sums})"
    p = "1 - " + lower_beta("(df_between * f / (df_within + df_between * f))", "(df_between / 2)", "(df_within / 2)")
    return sql(
        source,
        f"""SELECT df_between, df_within, round(ss_between, 6) AS ss_between, round(ss_within, 6) AS ss_within,
            round(f, 6) AS f, round(p, 6) AS p_value, CASE WHEN p < 0.05 THEN 'reject' ELSE 'fail to reject' END AS decision
        FROM (SELECT *, {p} AS p FROM ({inner}))""",
    )


def correlation(needs: str, source: str) -> str:
    return sql(
        needs,
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM {source}" for a in RFM for b in RFM
        ),
    )


def ranked(source: str, key: str, measure: str, name: str) -> str:
    return sql(source, f"SELECT {key}, {measure} AS {name} FROM {source} GROUP BY {key} ORDER BY {name} DESC, {key} LIMIT 10")


def scored() -> str:
    z = [
        f"((ln(1 + {c}) - {m}) / {s})"
        for c, m, s in zip(RFM, q.GIVEN_SCALING["means"], q.GIVEN_SCALING["stds"])
    ]
    names = " ".join(f"WHEN {i} THEN '{n}'" for i, n in q.GIVEN_SEGMENTS.items())
    return sql(
        "capped",
        f"""SELECT customer_id, cluster, CASE cluster {names} ELSE 'Regular' END AS segment
        FROM (SELECT customer_id, {nearest(z)}::INTEGER AS cluster FROM capped)""",
    )


def refined() -> str:
    """Rounds of assignment and averaging, one named part each."""
    body, centres = "", [tuple(map(str, c)) for c in q.GIVEN_CENTRES]
    for step in range(q.REFINE_STEPS):
        gaps = [distance(c, Z) for c in centres]
        whens = " ".join(f"WHEN {e} = least({', '.join(gaps)}) THEN {i}" for i, e in enumerate(gaps))
        means = ", ".join(f"avg({c}) AS m_{c}" for c in Z)
        body += f", step{step} AS (SELECT cluster, count(*) AS customers, {means} FROM (SELECT *, CASE {whens} END AS cluster FROM scaled) GROUP BY cluster)"
        centres = [tuple(f"(SELECT m_{c} FROM step{step} WHERE cluster = {i})" for c in Z) for i in range(len(centres))]
    shown = ", ".join(f"round(m_{c}, 6) AS {c}" for c in Z)
    return sql("scaled", f"{body} SELECT cluster::INTEGER AS cluster, customers, {shown} FROM step{q.REFINE_STEPS - 1}".lstrip())


def slopes(loglik, model, columns: str, step: float = 1e-4) -> str:
    """Central differences of a mean log-likelihood in each parameter of ``model``."""
    parts = []
    for name in columns.split():
        ends = [f"({loglik(replace(model, **{name: getattr(model, name) + s}), None)})" for s in (step, -step)]
        parts.append(f"SELECT '{name}' AS parameter, round(({ends[0]} - {ends[1]}) / {2 * step}, 5) AS slope")
    return sql("summary", " UNION ALL ".join(parts))


def loglik_purchases(g=q.GIVEN_PURCHASE, digits: int | None = 6) -> str:
    gone = f"ln({g.a}) - ln({g.b} + greatest(x, 1) - 1) - ({g.r} + x) * ln({g.alpha} + tx)"
    alive = f"-({g.r} + x) * ln({g.alpha} + t)"
    mix = f"CASE WHEN x > 0 THEN greatest({alive}, {gone}) + ln(1 + exp(-abs(({alive}) - ({gone})))) ELSE {alive} END"
    ll = (
        f"lgamma({g.r} + x) - lgamma({g.r}) + {g.r} * ln({g.alpha}) + lgamma({g.a} + {g.b}) + lgamma({g.b} + x) "
        f"- lgamma({g.b}) - lgamma({g.a} + {g.b} + x) + {mix}"
    )
    if digits is None:
        return f"SELECT avg({ll}) FROM summary"
    return sql("summary", f"SELECT round(avg({ll}), {digits}) AS mean_log_likelihood FROM summary")


def loglik_values(g=q.GIVEN_VALUE, digits: int | None = 6) -> str:
    m = "monetary_value"
    ll = (
        f"lgamma({g.p} * x + {g.q}) - lgamma({g.p} * x) - lgamma({g.q}) + {g.q} * ln({g.v}) + ({g.p} * x - 1) * ln({m}) "
        f"+ {g.p} * x * ln(x) - ({g.p} * x + {g.q}) * ln(x * {m} + {g.v})"
    )
    if digits is None:
        return f"SELECT avg({ll}) FROM summary WHERE x > 0"
    return sql("summary", f"SELECT round(avg({ll}), {digits}) AS mean_log_likelihood FROM summary WHERE x > 0")


def score_inputs() -> str:
    inputs = """SELECT customer_id, greatest(frequency - 1, 0.0) AS x, greatest(frequency - 1, 0.0) AS tx,
        greatest(frequency - 1, 0.0) + recency / 30 AS t, monetary / greatest(frequency, 1.0) AS monetary_value FROM capped"""
    return sql(
        "capped",
        f"""SELECT customer_id, {rounded('x tx t')}, monetary_value::FLOAT::DOUBLE AS monetary_value, round({expected(1)}, 6) AS expected_purchases,
        CASE WHEN x > 0 THEN round({clv_value()}, 6) ELSE 0.0 END AS predicted_clv FROM ({inputs})""",
    )


def silhouette(n: int = 500) -> str:
    gap = "sqrt(" + " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in Z) + ")"
    return sql(
        "assigned",
        f""", s AS (SELECT * FROM assigned ORDER BY md5(concat_ws('|', customer_id::VARCHAR, '42')), customer_id LIMIT {n}),
        m AS (SELECT a.customer_id, a.cluster AS own, b.cluster AS other, sum({gap}) AS total, count(*) AS n
              FROM s a, s b GROUP BY ALL),
        v AS (SELECT customer_id, max(n) FILTER (own = other) AS size,
                max(total) FILTER (own = other) / greatest(max(n) FILTER (own = other) - 1, 1) AS inside,
                min(total / n) FILTER (own <> other) AS outside FROM m GROUP BY customer_id)
        SELECT count(*) AS n, round(avg(CASE WHEN size > 1 THEN (outside - inside) / greatest(outside, inside) ELSE 0 END), 6)
            AS silhouette FROM v""".lstrip(),
    )


def target_rules() -> str:
    s = q.TARGET_SUPPORT
    return sql(
        "cleaned",
        f""", b AS (SELECT DISTINCT invoice_no, description FROM cleaned),
        total AS (SELECT count(DISTINCT invoice_no)::DOUBLE AS n FROM cleaned),
        one AS (SELECT description, count(*) AS n FROM b GROUP BY description),
        two AS (SELECT x.description AS item_a, y.description AS item_b, count(*) AS n
                FROM b x JOIN b y ON x.invoice_no = y.invoice_no AND x.description <> y.description GROUP BY ALL),
        r AS (SELECT item_a, item_b, (two.n / total.n) / (oa.n / total.n) AS confidence,
                (two.n / total.n) / (oa.n / total.n) / (ob.n / total.n) AS lift
              FROM two, total, one oa, one ob
              WHERE oa.description = item_a AND ob.description = item_b AND two.n / total.n >= {s})
        SELECT item_a AS description, rank, item_b AS item, round(lift, 6) AS lift, round(confidence, 6) AS confidence
        FROM (SELECT *, row_number() OVER (PARTITION BY item_a ORDER BY lift DESC, item_b) AS rank FROM r) WHERE rank <= 5""".lstrip(),
    )


TOP_WEIGHTED = """, w AS (SELECT description, customer_id, count(*)::DOUBLE AS n FROM cleaned GROUP BY ALL),
    square AS (SELECT description, sum(n * n) AS s FROM w GROUP BY description),
    dot AS (SELECT a.description AS item_a, b.description AS item_b, sum(a.n * b.n) AS d
            FROM w a JOIN w b ON a.customer_id = b.customer_id AND a.description <> b.description GROUP BY ALL),
    sim AS (SELECT item_a, item_b, d / sqrt(sa.s * sb.s) AS similarity FROM dot
            JOIN square sa ON sa.description = item_a JOIN square sb ON sb.description = item_b)
    SELECT item_a AS description, rank, item_b AS item, round(similarity, 6) AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_a ORDER BY similarity DESC, item_b) AS rank FROM sim) WHERE rank <= 5"""

AUDIT = f"""SELECT list_position(['copies', 'no_customer', 'admin_code', 'admin_text', 'cancelled', 'not_purchase', 'purchase'], stage)
        ::INTEGER AS step, stage, rows FROM (
    SELECT 'copies' AS stage, (SELECT count(*) FROM sales) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sales)) AS rows
    UNION ALL SELECT stage, count(*) FROM (
        SELECT CASE WHEN customer_id IS NULL THEN 'no_customer' WHEN {BAD_CODE} THEN 'admin_code'
            WHEN {BAD_TEXT.replace('upper(description)', TIDY)} THEN 'admin_text' WHEN {VOID} THEN 'cancelled'
            WHEN NOT (quantity > 0 AND unit_price > 0) THEN 'not_purchase' ELSE 'purchase' END AS stage
        FROM (SELECT DISTINCT * FROM sales)) GROUP BY stage)"""

DOUBTFUL = """SELECT *, CASE reason WHEN 'malformed' THEN 'surplus' WHEN 'quantity' THEN 'x' || quantity WHEN 'invoice_date' THEN 'yesterday'
        WHEN 'unit_price' THEN 'about' WHEN 'customer_id' THEN 'no' END AS rejected
    FROM (SELECT *, CASE WHEN n % 71 = 3 THEN 'malformed' WHEN n % 89 = 3 THEN 'quantity' WHEN n % 83 = 3 THEN 'invoice_date'
        WHEN n % 79 = 3 THEN 'unit_price' WHEN n % 73 = 3 AND customer_id IS NOT NULL THEN 'customer_id' ELSE 'good' END AS reason
        FROM (SELECT *, replace(invoice_no, 'C', '')::BIGINT AS n FROM sales))"""

ASKED = "('0x' || substr(md5(description), 1, 8))::BIGINT % 50 = 0"

LINES_OF = "SELECT {columns} FROM {source}"

COLUMN_TYPES = {
    "invoice_no": "string", "stock_code": "string", "description": "string", "quantity": "int",
    "invoice_date": "timestamp", "unit_price": "double", "customer_id": "double", "country": "string",
}
BOTH_KNOWN = """SELECT customer_id::BIGINT::VARCHAR AS who, x, tx, t, monetary_value FROM summary
    UNION ALL SELECT 'new ' || customer_id::BIGINT::VARCHAR, 0, 0, t, monetary_value FROM summary"""

ORACLES: dict[str, str] = {
    "scan_csv_roundtrip": sql("sales", f"SELECT {SHOWN} FROM sales"),
    "normalize_types": sql(
        "capped",
        "SELECT customer_id, round_even(recency / 2, 0)::INTEGER AS recency, "
        "round_even(frequency / 2, 0)::INTEGER AS frequency, round(return_ratio, 6) AS return_ratio FROM capped",
    ),
    "reco_lookup_fallback": sql(
        "sales item_recs best",
        f""", asked AS (SELECT {TIDY} AS description FROM sales UNION SELECT p_name FROM part)
        SELECT asked.description, false AS is_fallback, rank, item, round(score, 6) AS score FROM asked JOIN item_recs USING (description)
        UNION ALL SELECT description, true, rank, item, n_lines::DOUBLE FROM asked, best
        WHERE description NOT IN (SELECT description FROM item_recs)""".lstrip(),
    ),
    "clean_dedupe": sql("sales", f"SELECT DISTINCT {SHOWN} FROM sales"),
    "clean_customer_not_null": sql(
        "sales",
        f"SELECT {SHOWN.replace('customer_id', 'customer_id::BIGINT AS customer_id')} FROM sales WHERE customer_id IS NOT NULL",
    ),
    "pre_cancellation": sql("pre", f"SELECT {SHOWN} FROM pre"),
    "clean_description": sql("sales", f"SELECT {SHOWN.replace('description', TIDY + ' AS description')} FROM sales"),
    "clean_stock_codes": sql("sales", f"SELECT {SHOWN} FROM sales WHERE NOT {BAD_CODE}"),
    "clean_keywords": sql(
        "sales",
        f"SELECT {SHOWN} FROM (SELECT {LINE.replace('description', TIDY + ' AS description')} FROM sales) WHERE NOT {BAD_TEXT}",
    ),
    "clean_cancellations": sql("sales", f"SELECT {SHOWN} FROM sales WHERE NOT {VOID}"),
    "line_amount": sql("sales", f"SELECT {SHOWN}, quantity * unit_price AS total_amount FROM sales"),
    "parse_mixed_dates": sql(
        "sales",
        "SELECT invoice_no, stock_code, quantity, "
        "strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date FROM sales",
    ),
    "purchases_only": sql("sales", f"SELECT {SHOWN} FROM sales WHERE quantity > 0 AND unit_price > 0"),
    "clean_retail": sql("cleaned", f"SELECT {SHOWN}, total_amount FROM cleaned"),
    "clean_audit": sql("sales", AUDIT),
    "frequency_sketched": sql("purchases", "SELECT customer_id, count(DISTINCT invoice_no) AS frequency, true AS within_bound FROM purchases GROUP BY customer_id"),
    "country_reach_sketched": sql("purchases", "SELECT country, count(DISTINCT customer_id) AS customers, true AS within_bound FROM purchases GROUP BY country"),
    "quantiles_sketched": " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {s}::DOUBLE AS q, true AS within_bound" for c in q.SKETCHED for s in q.QUARTERS),
    "months_rebuilt": sql("cleaned", f"SELECT {MONTH} AS month, count(*) AS lines, sum(quantity)::BIGINT AS quantity FROM cleaned GROUP BY ALL"),
    "bucketed_customer_totals": sql(
        "purchases capped",
        "SELECT customer_id::BIGINT AS customer_id, lines, round(frequency, 6) AS frequency FROM capped JOIN (SELECT customer_id, count(*) AS lines FROM purchases GROUP BY customer_id) USING (customer_id)",
    ),
    "clean_audit_observed": sql("sales", AUDIT),
    "clean_retail_observed": sql("cleaned", f"SELECT {SHOWN}, total_amount FROM cleaned"),
    "quarantined_lines": sql("sales", f"SELECT reason, invoice_no, stock_code, rejected FROM ({DOUBTFUL}) WHERE reason <> 'good'"),
    "quarantine_counts": sql("sales", f"SELECT reason, count(*) AS lines FROM ({DOUBTFUL}) GROUP BY reason"),
    "quarantine_accepted": sql("sales", f"SELECT {SHOWN} FROM ({DOUBTFUL}) WHERE reason = 'good'"),
    "profile_columns": profile("sales", "sales", ["quantity", "unit_price", "customer_id"]),
    "profile_all_columns": sql(
        "sales",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column, '{kind}' AS type, count({c}) AS non_null, count(*) - count({c}) AS nulls FROM sales"
            for c, kind in COLUMN_TYPES.items()
        ),
    ),
    "profile_rfm": profile("capped", "capped", [*RFM, "return_ratio"]),
    "rfm_base": sql("rfm", "SELECT customer_id, recency, frequency, round(monetary, 6) AS monetary FROM rfm"),
    "return_ratio": sql("ratio", "SELECT customer_id, round(return_ratio, 6) AS return_ratio FROM ratio"),
    "rfm_with_returns": sql(
        "full_rfm",
        "SELECT customer_id, recency, frequency, " + rounded("monetary return_ratio") + " FROM full_rfm",
    ),
    "rfm_capped": sql("capped", "SELECT customer_id, " + rounded("recency frequency monetary return_ratio") + " FROM capped"),
    "rfm_cleaned_basis": sql(
        "rfm_cleaned", "SELECT customer_id, recency, frequency, round(monetary, 6) AS monetary FROM rfm_cleaned"
    ),
    "rfm_scaled": sql("scaled", "SELECT customer_id, " + rounded(" ".join(Z)) + " FROM scaled"),
    "kmeans_inertia": sql(
        "scaled",
        "SELECT round(sum(least(" + ", ".join(distance(c, Z) for c in q.GIVEN_CENTRES) + ")), 6) AS inertia FROM scaled",
    ),
    "silhouette_sample": silhouette(),
    "silhouette_sample_10000": silhouette(10_000),
    "kmeans_refined": refined(),
    "cluster_profiles": sql("profiles", "SELECT cluster, " + rounded("recency frequency monetary return_ratio") + " FROM profiles"),
    "segment_labels": sql("labels", "SELECT cluster, segment FROM labels"),
    "segmented_customers": sql(
        "segmented", "SELECT customer_id, cluster, segment, round(monetary, 6) AS monetary FROM segmented"
    ),
    "elbow_single_cluster": sql(
        "scaled", "SELECT 1::INTEGER AS k, round(" + " + ".join(f"var_pop({c}) * count(*)" for c in Z) + ", 6) AS inertia FROM scaled"
    ),
    "score_segments": scored(),
    "segment_summary": sql(
        "segmented valued",
        "SELECT segment, "
        + ", ".join(
            f"round(avg(coalesce({c}, 0)), 6) AS {c}" for c in [*RFM, "return_ratio", "expected_purchases", "predicted_clv"]
        )
        + ", count(*) AS customers FROM segmented LEFT JOIN valued USING (customer_id) GROUP BY segment",
    ),
    "segment_distribution": sql("segmented", "SELECT segment, count(*) AS customers FROM segmented GROUP BY segment"),
    "kpi_summary": sql(
        "segmented",
        """SELECT count(*) AS customers, count(*) FILTER (segment = 'High-Value') AS high_value,
        round(100 * count(*) FILTER (segment = 'High-Value') / count(*), 6) AS high_value_pct,
        round(avg(recency), 6) AS mean_recency, round(avg(monetary), 6) AS mean_monetary FROM segmented""",
    ),
    "sample_exact_n": sql(
        "cleaned",
        f"SELECT invoice_no, stock_code, quantity, description, unit_price FROM cleaned ORDER BY {SAMPLE_ORDER} LIMIT 10000",
    ),
    "segment_scatter": sql(
        "segmented",
        f"SELECT customer_id, {rounded('recency frequency monetary')}, segment FROM segmented "
        "ORDER BY md5(concat_ws('|', customer_id::VARCHAR, '42')), customer_id LIMIT 3000",
    ),
    "segment_actions": sql(
        "segmented",
        "SELECT customer_id, segment, profile, action FROM segmented LEFT JOIN (VALUES "
        + ", ".join(f"({text(a)}, {text(b)}, {text(c)})" for a, b, c in SEGMENT_NOTES)
        + ") n(segment, profile, action) USING (segment)",
    ),
    "clv_summary": sql("summary", "SELECT customer_id, x, " + rounded("tx t") + ", monetary_value::FLOAT::DOUBLE AS monetary_value FROM summary"),
    "bgnbd_gradient": slopes(loglik_purchases, q.GIVEN_PURCHASE, "r alpha a b"),
    "gammagamma_gradient": slopes(loglik_values, q.GIVEN_VALUE, "p q v"),
    "bgnbd_loglik": loglik_purchases(),
    "gammagamma_loglik": loglik_values(),
    "expected_purchases": sql("valued", "SELECT customer_id, round(expected_purchases, 6) AS expected_purchases FROM valued"),
    "predicted_clv": sql("valued", "SELECT customer_id, round(predicted_clv, 6) AS predicted_clv FROM valued"),
    "score_clv_inputs": score_inputs(),
    "expected_purchases_low_dropout": sql(
        "summary", f"SELECT who, round({expected_integrated(1)}, 6) AS expected_purchases FROM ({BOTH_KNOWN})"
    ),
    "predicted_clv_low_dropout": sql(
        "summary", f"SELECT who, round({clv_value(expected_integrated)}, 4) AS predicted_clv FROM ({BOTH_KNOWN}) WHERE x > 0"
    ),
    "bgnbd_loglik_low_dropout": loglik_purchases(q.LOW_DROPOUT),
    "gammagamma_loglik_low_spread": loglik_values(q.LOW_SPREAD),
    "popular_items": sql(
        "item_lines", f"SELECT description, n_lines FROM item_lines WHERE n_lines >= {q.POPULAR_LINES}"
    ),
    "interactions_binary": sql(
        "purchases item_lines",
        f"""SELECT DISTINCT description, customer_id FROM purchases
        WHERE description IN (SELECT description FROM item_lines WHERE n_lines >= 5)""",
    ),
    "interactions_binary_popular": sql(
        "purchases item_lines",
        f"""SELECT DISTINCT description, customer_id FROM purchases
        WHERE description IN (SELECT description FROM item_lines WHERE n_lines >= {q.POPULAR_LINES})""",
    ),
    "catalog_listed": sql("item_recs", "SELECT DISTINCT description FROM item_recs"),
    "rules_lookup_fallback": sql(
        "cleaned rules best",
        """, asked AS (SELECT p_name AS description FROM part UNION SELECT description FROM cleaned),
        top AS (SELECT item_a AS description, item_b AS item, lift, confidence,
                row_number() OVER (PARTITION BY item_a ORDER BY lift DESC, confidence DESC, item_b) AS rank FROM rules QUALIFY rank <= 5)
        SELECT description, false AS is_fallback, rank, item, round(lift, 6) AS lift, round(confidence, 6) AS confidence
        FROM asked JOIN top USING (description)
        UNION ALL SELECT description, true, rank, item, 1.0, 1.0 FROM asked, best WHERE description NOT IN (SELECT description FROM top)""".lstrip(),
    ),
    "item_cosine": sql("cosine", "SELECT item_a, item_b, common, round(similarity, 6) AS similarity FROM cosine"),
    "item_cf_topn": sql("item_recs", "SELECT description, rank, item, round(score, 6) AS score FROM item_recs"),
    "item_cosine_weighted": sql("cleaned", TOP_WEIGHTED),
    "bestsellers": sql("best", "SELECT rank, item, n_lines FROM best"),
    "catalog": sql("purchases", "SELECT DISTINCT description FROM purchases"),
    "basket_pairs": sql("rules", "SELECT item_a, item_b, co_occurrences FROM rules"),
    "association_rules": sql(
        "rules",
        "SELECT item_a, item_b, co_occurrences, support_a, support_b, " + rounded("confidence lift") + " FROM rules",
    ),
    "rules_topn": sql(
        "rules",
        """SELECT item_a AS description, rank, item_b AS item, round(lift, 6) AS lift, round(confidence, 6) AS confidence
        FROM (SELECT *, row_number() OVER (PARTITION BY item_a ORDER BY lift DESC, confidence DESC, item_b) AS rank FROM rules)
        WHERE rank <= 5""",
    ),
    "rules_fallback": sql("best", "SELECT rank, item, 1.0::DOUBLE AS lift, 1.0::DOUBLE AS confidence FROM best"),
    "rules_global_top": sql(
        "rules",
        f"SELECT item_a, item_b, {rounded('confidence lift')} FROM rules ORDER BY rules.lift DESC, item_a, item_b LIMIT 10",
    ),
    "rules_for_target": target_rules(),
    "rules_for_asked": f"SELECT * FROM ({target_rules()}) WHERE {ASKED}",
    "similar_items_weighted_for": f"SELECT * FROM ({sql('cleaned', TOP_WEIGHTED)}) WHERE {ASKED}",
    "user_neighbors": sql(
        "neighbors", "SELECT customer_id, neighbor, round(similarity, 6) AS similarity, rank FROM neighbors"
    ),
    "user_cf_recs": sql("user_recs", "SELECT customer_id, rank, item, score FROM user_recs"),
    "user_neighbors_for": sql(
        "neighbors", "SELECT customer_id, neighbor, round(similarity, 6) AS similarity, rank FROM neighbors WHERE customer_id % 50 = 0"
    ),
    "user_cf_recs_for": sql("user_recs", "SELECT customer_id, rank, item, score FROM user_recs WHERE customer_id % 50 = 0"),
    "content_similar_for": sql(
        "desc_near",
        f"SELECT * FROM desc_near WHERE {ASKED}",
    ),
    "user_cf_fallback": sql(
        "user_recs best",
        """SELECT c_custkey AS customer_id, false AS is_fallback, rank, item, score
        FROM customer JOIN user_recs ON customer_id = c_custkey
        UNION ALL SELECT c_custkey, true, rank, item, 1.0 FROM customer, best
        WHERE c_custkey NOT IN (SELECT customer_id FROM user_recs)""",
    ),
    "tfidf_weights": sql("desc_weights", "SELECT description, token, tf, df, round(weight, 6) AS weight FROM desc_weights"),
    "tfidf_documents": sql("doc_weights", "SELECT doc_id, token, tf, df, round(weight, 6) AS weight FROM doc_weights"),
    "content_similar": sql("desc_near", "SELECT * FROM desc_near"),
    "content_similar_documents": sql("doc_near", "SELECT * FROM doc_near"),
    "customer_list": sql("cleaned", "SELECT DISTINCT customer_id FROM cleaned"),
    "top_countries_lines": ranked("cleaned", "country", "count(*)", "n_lines"),
    "top_countries_revenue": ranked("cleaned", "country", "round(sum(total_amount), 6)", "revenue"),
    "aov_by_country": sql(
        "cleaned",
        """SELECT country, round(avg(total), 6) AS avg_order_value
        FROM (SELECT country, invoice_no, sum(total_amount) AS total FROM cleaned GROUP BY ALL)
        GROUP BY country ORDER BY avg_order_value DESC, country LIMIT 10""",
    ),
    "top_products_qty": ranked("cleaned", "description", "sum(quantity)::BIGINT", "sum_qty"),
    "top_products_revenue": ranked("cleaned", "description", "round(sum(total_amount), 6)", "revenue"),
    "hist_unit_price": histogram("cleaned", "cleaned", {"unit_price": ("unit_price", "unit_price <= 15")}),
    "hist_line_value": histogram("cleaned", "cleaned", {"line_value": ("total_amount", "quantity > 0")}),
    "hist_line_value_clipped": histogram(
        "cleaned", "cleaned", {"line_value": ("total_amount", "quantity > 0 AND total_amount <= 100")}
    ),
    "hist_quantity": histogram("cleaned", "cleaned", {"quantity": ("quantity", "quantity <= 50")}),
    "hist_rfm": histogram(
        "capped", "capped", {**{c: (c, "true") for c in RFM}, **{f"log_{c}": (f"ln(1 + {c})", "true") for c in RFM}}
    ),
    "kde_rfm": density("capped", "capped", RFM),
    "kde_rfm_log": density("capped", f"(SELECT {', '.join(f'ln(1 + {c}) AS log_{c}' for c in RFM)} FROM capped)", [f"log_{c}" for c in RFM]),
    "kde_unit_price": density("cleaned", "(SELECT * FROM cleaned WHERE unit_price <= 15)", ["unit_price"]),
    "monthly_revenue": sql(
        "cleaned", f"SELECT {MONTH} AS month, round(sum(total_amount), 6) AS revenue FROM cleaned WHERE quantity > 0 GROUP BY ALL"
    ),
    "monthly_revenue_all_lines": sql(
        "cleaned", f"SELECT {MONTH} AS month, round(sum(total_amount), 6) AS revenue FROM cleaned GROUP BY ALL"
    ),
    "monthly_orders": sql(
        "cleaned", f"SELECT {MONTH} AS month, count(DISTINCT invoice_no) AS orders FROM cleaned WHERE quantity > 0 GROUP BY ALL"
    ),
    "monthly_orders_all_lines": sql(
        "cleaned", f"SELECT {MONTH} AS month, count(DISTINCT invoice_no) AS orders FROM cleaned GROUP BY ALL"
    ),
    "orders_by_weekday": sql(
        "cleaned",
        "SELECT day_order, weekday, orders FROM (VALUES "
        + ", ".join(f"({i}, '{d}')" for i, d in enumerate(REPORT_WEEKDAYS))
        + """) d(day_order, weekday) LEFT JOIN (SELECT dayname(invoice_date) AS weekday, count(DISTINCT invoice_no) AS orders
        FROM cleaned GROUP BY ALL) USING (weekday)""",
    ),
    "orders_by_hour": sql(
        "cleaned",
        "SELECT hour(invoice_date)::INTEGER AS hour, count(DISTINCT invoice_no) AS orders FROM cleaned GROUP BY ALL",
    ),
    "scatter_price_qty": sql(
        "cleaned",
        f"""SELECT unit_price, quantity, total_amount FROM (SELECT * FROM cleaned ORDER BY {SAMPLE_ORDER} LIMIT 1000)
        WHERE unit_price <= 50""",
    ),
    "cohort_acquisition": sql(
        "cleaned",
        f"""SELECT {MONTH} AS cohort_month, count(*) AS new_customers
        FROM (SELECT customer_id, min(invoice_date) AS invoice_date FROM cleaned GROUP BY customer_id) GROUP BY ALL""",
    ),
    "first_purchase_window": sql(
        "cleaned",
        """SELECT customer_id, invoice_no, stock_code, quantity,
        strftime(min(invoice_date) OVER (PARTITION BY customer_id), '%Y-%m') AS first_purchase_month FROM cleaned""",
    ),
    "rfm_correlation": correlation("rfm_cleaned", "rfm_cleaned"),
    "rfm_correlation_capped": correlation("capped", "capped"),
    "welch_ttest": welch("purchases"),
    "welch_ttest_cleaned": welch("cleaned"),
    "pearson_test": pearson("purchases", "purchases"),
    "pearson_test_sampled": pearson("purchases", f"(SELECT * FROM purchases ORDER BY {SAMPLE_ORDER} LIMIT 10000)"),
    "anova_weekday": anova("purchases"),
    "anova_weekday_cleaned": anova("cleaned"),
}
