"""SQL of the corpus queries that SQL can express."""

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


def components(percent: int, columns: str) -> str:
    """Components of documents whose sets of 5-word shingles are similar; links, and what they reach, by brute force."""
    return rf"""
        WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS words FROM documents),
        shingles AS MATERIALIZED (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS s FROM w
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT p.a, p.b FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
            ) p JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b WHERE 100 * shared >= {percent} * (m.n + n.n - shared)
        ),
        reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
        least AS (SELECT a AS doc_id, min(b) AS component FROM reach GROUP BY a),
        linked AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a),
        found AS (
            SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(component, w.doc_id)) AS component_id, coalesce(n_links, 0) AS n_links
            FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id) LEFT JOIN linked USING (doc_id)
        )
        SELECT doc_id, n_shingles, component_id, {columns} FROM found
    """


#: The unsigned CRC32 of ``bytes``, a list of numbers, with the table of ``crc_table``.
CRC_TABLE = """crc_table AS (
            SELECT list(v ORDER BY i) AS tab FROM (
                SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM range(256) t(i)
            )
        )"""
CRC = "xor(list_reduce(list_concat([4294967295], {bytes}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"
DIGITS = "list_transform(string_split({0}::VARCHAR, ''), lambda d: ord(d)::BIGINT)"

TRIE = rf"""
        WITH {CRC_TABLE},
        own AS (
            SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ),
        folded AS (SELECT conv_id, turns, {CRC.format(bytes=DIGITS.format("conv_id"))} % 4 AS h FROM own, crc_table),
        rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:h], c.turns[h + 1:]) AS turns
            FROM folded c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
        ),
        members AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
        nodes AS (
            SELECT md5(turns[1:depth]::VARCHAR) AS path, any_value(turns[1:depth]) AS turns, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256
            FROM members GROUP BY md5(turns[1:depth]::VARCHAR), depth
        ),
        sized AS (
            SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(turns[depth].text, '[^\x20\x09-\x0D]+')) END AS saved,
                   CASE WHEN depth > 0 THEN md5(turns[1:depth - 1]::VARCHAR) END AS parent FROM nodes
        ),
        kids AS (SELECT parent AS path, count(*) AS n_children FROM sized WHERE parent IS NOT NULL GROUP BY parent),
        leafed AS (SELECT sized.*, coalesce(n_children, 0) AS n_children FROM sized LEFT JOIN kids USING (path)),
        below AS (
            SELECT md5(turns[1:d]::VARCHAR) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
            FROM (SELECT turns, n_children, saved, unnest(range(0, depth + 1)) AS d FROM leafed) GROUP BY 1
        )
        SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
               x.ends_sha256
        FROM leafed x JOIN below USING (path) LEFT JOIN nodes p ON p.path = x.parent
    """

RESAMPLING = rf"""
        WITH {CRC_TABLE},
        texts AS (
            SELECT 'd' AS side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
            UNION ALL SELECT 'b', NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
        ),
        places AS (SELECT side, doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM texts),
        grams AS (
            SELECT side, doc_id, unnest(list_transform(range(0, least(3, len(words) - i + 1)), lambda k: array_to_string(words[i:i + k], ' '))) AS gram FROM places
        ),
        counts AS MATERIALIZED (SELECT side, doc_id, gram, count(*) AS n FROM grams GROUP BY ALL),
        coded AS MATERIALIZED (
            SELECT gram, {CRC.format(bytes="list_transform(range(1, strlen(gram) + 1), lambda i: ('0x' || substr(hex(encode(gram)), 2 * i - 1, 2))::BIGINT)")} % 10000 AS bucket
            FROM (SELECT DISTINCT gram FROM counts), crc_table
        ),
        filled AS MATERIALIZED (SELECT side, doc_id, bucket, sum(n)::BIGINT AS n FROM counts JOIN coded USING (gram) GROUP BY ALL),
        buckets AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM filled GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM buckets) + 10000) / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM buckets) + 10000)))) AS gain FROM buckets
        ),
        weights AS (SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM filled JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id),
        scored AS (
            SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(words) >= 20 AS able,
                   (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
            FROM texts LEFT JOIN weights USING (doc_id) WHERE side = 'd'
        ),
        placed AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= (SELECT 5 * count(*) // 100 FROM scored WHERE able) THEN place END AS rank FROM placed
    """

ORACLES = {
    "op1_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ),
        sized AS (
            SELECT *, length(text) + len(regexp_extract_all(text, '\\')) +
                   len(regexp_extract_all(text, '<<SYS>>|<</SYS>>|<s>|</s>|\[/?INST\]|\[/?ROLE\]'))
                   + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 ELSE 17 + length(role) END AS chars
            FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               (3 + sum(chars))::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op2_quality_rules": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        w AS (
            SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
            FROM d
        ),
        windows AS (
            SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
        ),
        repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
        covered AS (
            SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS place FROM repeated) GROUP BY doc_id
        ),
        c AS (
            SELECT w.doc_id, text, words, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
            FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id
        ),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed
                    OR n_symbols > 0.1 * n_words
                    OR (n_dup_lines > 2 AND n_dup_lines > 0.3 * n_lines)
                    OR 4 * n_repeat_words > n_words
                    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                    OR 10 * len(list_distinct(words)) < n_words
                    OR length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) > 0.4 * word_chars
                    OR 5 * len(regexp_extract_all(text, '!')) > 2 * n_words
                    OR 2 * length(regexp_replace(text, '[^\p{L}]+', '', 'g')) < word_chars) AS kept
        FROM b
    """,
    "op4_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        ranked AS (
            SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
                   row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text
            FROM d
        )
        SELECT doc_id, keep_id, group_size, kept, sha256(text) AS text_sha256 FROM ranked
    """,
    "op8_minhash": components(75, "doc_id = component_id AS kept"),
    "op11_resampling": RESAMPLING,
    "op12_jaccard_join": components(80, "n_links"),
    "op13_prefix_trie": TRIE,
}
