"""DuckDB statements for the contract queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_chat_trees"] = r"""
WITH every AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
    SELECT *,
        length(regexp_replace(replace(role, '\', '\\'),
            '([<\[])(\||s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\])', '\1\\\2', 'g')) AS role_chars,
        length(regexp_replace(replace(text, '\', '\\'),
            '([<\[])(\||s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\])', '\1\\\2', 'g')) AS text_chars
    FROM every
), learnt AS (
    SELECT conv_id, string_agg(text, '' ORDER BY turn, role, text) AS loss
    FROM every WHERE role = 'assistant' GROUP BY conv_id
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(sum(24 + role_chars + text_chars) AS BIGINT) AS formatted_chars
    FROM escaped GROUP BY conv_id
)
SELECT w.conv_id, w.n_turns, w.turns_sha256,
    CAST(length(coalesce(loss, '')) AS BIGINT) AS loss_chars, sha256(coalesce(loss, '')) AS loss_sha256, w.formatted_chars
FROM whole w LEFT JOIN learnt l ON l.conv_id IS NOT DISTINCT FROM w.conv_id
"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: the line rules restate kinscore.llm.quality_rules with its lists
_NAV = "home about contact login logout menu search next previous prev back top share print faq help sitemap register subscribe signup sign cart account"
_BOILERPLATE = (
    "all rights reserved|terms of use|terms of service|privacy policy|cookie policy|uses cookies|"
    "enable javascript|click here to|subscribe to our newsletter|lorem ipsum"
)

ORACLE_SQL["op7_quality_rules"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
    FROM (SELECT rid, {_WORDS.format("text")} AS ws FROM docs)
), per_word AS (
    SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY rid
), windows AS (
    SELECT rid, pos, w AS w1, lead(w, 1) OVER s AS w2, lead(w, 2) OVER s AS w3
    FROM words WINDOW s AS (PARTITION BY rid ORDER BY pos)
), twice AS (
    SELECT rid, pos FROM windows WHERE w3 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, w1, w2, w3) > 1
), repeated AS (
    SELECT rid, count(DISTINCT pos + k) AS n FROM twice, unnest([0, 1, 2]) AS t(k) GROUP BY rid
), lines AS (
    SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS place
    FROM (SELECT rid, string_split(text, chr(10)) AS ls FROM docs)
), cut AS (
    SELECT rid, line, place, {_WORDS.format("line")} AS ws FROM lines
), judged AS (
    SELECT rid, row_number() OVER (PARTITION BY rid, line ORDER BY place) > 1 AS dup,
        list_sum([length(x) FOR x IN ws]) AS chars,
        100 * (length(line) - length(regexp_replace(line, '[!-/:-@\[-`{{-~]', '', 'g')))
            > 15 * list_sum([length(x) FOR x IN ws])
        OR (len([x FOR x IN ws IF x IN ('|', '>', '/', '»', '•')]) >= 3
            AND 100 * len([x FOR x IN ws IF x IN ('|', '>', '/', '»', '•')]) >= 20 * len(ws))
        OR (len(ws) <= 8 AND 2 * len([x FOR x IN ws IF list_contains(string_split('{_NAV}', ' '), lower(x))]) > len(ws))
        OR regexp_matches(lower(line), '{_BOILERPLATE}') AS fails
    FROM cut WHERE len(ws) > 0
), per_line AS (
    SELECT rid, count_if(dup) AS n_dup, count_if(fails) AS n_fail,
        coalesce(sum(chars) FILTER (WHERE NOT fails), 0) AS kept_chars
    FROM judged GROUP BY rid
), base AS (
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
        coalesce(n_words, 0) < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed,
        coalesce(n_fail, 0) AS n_removed_lines, coalesce(kept_chars, 0) AS kept_chars
    FROM docs d LEFT JOIN per_word USING (rid) LEFT JOIN repeated r USING (rid) LEFT JOIN per_line USING (rid)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    CAST(n_removed_lines AS BIGINT) AS n_removed_lines, CAST(kept_chars AS BIGINT) AS kept_chars,
    NOT base_failed AND 100 * kept_chars >= 50 * word_chars AS kept
FROM base
"""

ORACLE_SQL["op6_substring_dedup"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT rid, doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
    FROM (SELECT rid, doc_id, {_WORDS.format("text")} AS ws FROM docs)
), windows AS (
    SELECT rid, doc_id, pos,
        list(w) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS win
    FROM words
), duplicate AS (
    SELECT rid, pos FROM windows WHERE len(win) = 13 QUALIFY min(doc_id) OVER (PARTITION BY win) < doc_id
), covered AS (
    SELECT DISTINCT rid, pos + k AS pos FROM duplicate, range(13) AS t(k)
), kept AS (
    SELECT rid, count(*) AS n, string_agg(w, ' ' ORDER BY pos) AS text
    FROM words ANTI JOIN covered USING (rid, pos) GROUP BY rid
), counted AS (
    SELECT rid, count(*) AS n FROM words GROUP BY rid
)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_words,
    CAST(coalesce(c.n, 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN counted c USING (rid) LEFT JOIN kept k USING (rid)
"""

_PLAIN_WORDS = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL["op11_wu_manber"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, {_PLAIN_WORDS.format("text")} AS ws FROM documents
), items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_PLAIN_WORDS.format("text")} AS ws FROM benchmark
), patterns AS (
    SELECT DISTINCT item, least(len(ws), 10) AS n, ws[p : p + least(len(ws), 10) - 1] AS win
    FROM items, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS t(p) WHERE len(ws) > 0
), places AS (
    SELECT rid, p, list(w) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS win
    FROM (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM docs)
), hits AS (
    SELECT rid, p, s.n, item FROM (SELECT rid, p, n, win[1:n] AS win FROM places, (SELECT DISTINCT n FROM patterns) WHERE len(win) >= n) s
    JOIN patterns USING (n, win)
), covered AS (
    SELECT rid, count(DISTINCT p + k) AS n_hit FROM hits, unnest(range(n)) AS t(k) GROUP BY rid
), named AS (
    SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""


def _kmeans_sql(rounds: int = 5) -> str:
    """The rounds written out one after the other."""
    parts = ["""
kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, [floor(256 * CAST(v AS DOUBLE)) FOR v IN embedding] AS x
    FROM embeddings WHERE len(embedding) = 64 AND len([1 FOR v IN embedding IF v IS NULL OR NOT isfinite(v)]) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, x) - 1 AS num, x AS c
    FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM kept) ORDER BY h, x LIMIT 40
)"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
    SELECT rid, vec_id, x, num, c, CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS BIGINT) AS d
    FROM kept, c{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, num) = 1
)""")
        if r < rounds:
            parts.append(f"""
s{r} AS (
    SELECT num, i, CAST(sum(CAST(x[i] AS BIGINT)) AS BIGINT) AS s, count(*) AS n FROM a{r}, unnest(range(1, 65)) AS t(i) GROUP BY num, i
), c{r + 1} AS MATERIALIZED (
    SELECT num, coalesce(m, c) AS c FROM c{r}
    LEFT JOIN (SELECT num, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS m FROM s{r} GROUP BY num) USING (num)
)""")
    return "WITH " + ",".join(parts) + f"""
SELECT vec_id, CAST(num AS INTEGER) AS cluster, d AS distance,
    CAST(sum(d) OVER (PARTITION BY num) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string([CAST(CAST(v AS BIGINT) AS VARCHAR) FOR v IN c], ',')) AS centroid_sha256
FROM a{rounds}
"""


ORACLE_SQL["op12_ns_kmeans"] = _kmeans_sql()

_STATE = "CASE WHEN {q} = 2 THEN 3 ELSE 2 END"

ORACLE_SQL["op13_dialogue_repair"] = rf"""
WITH RECURSIVE crc_table AS MATERIALIZED (
    SELECT list(v ORDER BY n) AS crc FROM (
        SELECT n, list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) AS t(n))
), keyed AS MATERIALIZED (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_concat([4294967295], [CAST(ascii(ch) AS BIGINT) FOR ch IN string_split(
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]),
            lambda c, b: xor(c // 256, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k
    FROM conversations, crc_table
), hurt AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
        CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM keyed, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS t(copy)
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i,
        NOT regexp_matches(text, '[^ 	-
]') AS blank,
        NOT regexp_matches(text, '[.!?][ 	-
]*$') AS open
    FROM hurt
), faults AS MATERIALIZED (
    SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
        left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
    FROM placed
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
        count_if(duplicate) AS duplicate, count_if(open AND NOT blank AND NOT duplicate) AS truncated,
        count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM faults GROUP BY conv_id
), fill AS (
    SELECT * FROM (VALUES (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
        (0, 2, 'I', 5, ['user:']), (1, 2, 'I', 5, ['user:']), (2, 3, 'I', 5, ['assistant:']), (3, 2, 'I', 5, ['user:']),
        (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 3, 'II', 10, ['user:', 'assistant:'])) AS t(q, q2, e, c, turns)
), step AS (
    SELECT conv_id, i, q, e, c, q2, turns FROM (
        SELECT conv_id, i, q, 'D' AS e, 2 AS c, q AS q2, CAST([] AS VARCHAR[]) AS turns FROM faults, range(4) AS t(q)
        UNION ALL
        SELECT conv_id, i, q, 'K', 5 * CAST(open AS INT), q2, [role || ':' || text] FROM faults
        JOIN (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)) AS t(initial, q, q2) ON left(role, 1) = initial
        WHERE NOT blank AND NOT duplicate
        UNION ALL
        SELECT conv_id, i, q, 'R', 1 + 5 * CAST(open AS INT), {_STATE.format(q="q")},
            [CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END || text]
        FROM faults, range(4) AS t(q) WHERE NOT blank AND NOT duplicate
    )
), best AS (
    SELECT conv_id, 0 AS i, 0 AS q, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS turns FROM counts
    UNION ALL
    SELECT conv_id, i, q, cost, audit, turns FROM (
        SELECT b.conv_id, b.i + 1 AS i, s.q2 AS q, CAST(b.cost + f.c + s.c AS INT) AS cost, b.audit || f.e || s.e AS audit,
            list_concat(list_concat(b.turns, f.turns), s.turns) AS turns
        FROM best b JOIN fill f ON f.q = b.q JOIN step s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i AND s.q = f.q2
    ) QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1
), ended AS (
    SELECT b.conv_id, cost + f.c AS cost, audit || f.e AS audit, list_concat(b.turns, f.turns) AS turns
    FROM best b JOIN counts n ON n.conv_id IS NOT DISTINCT FROM b.conv_id AND n.n = b.i JOIN fill f ON f.q = b.q
    WHERE f.q2 IN (0, 3) QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY cost + f.c, audit || f.e) = 1
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(turns, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
"""
