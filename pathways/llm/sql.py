"""Reference SQL of those text queries that SQL can express."""

from __future__ import annotations

from .ngram_join import PERCENT
from .quality import RULES, STOP_WORDS

EXACT_DEDUP = r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW same AS (PARTITION BY norm)
"""


def _rules() -> str:
    tests = []
    for r in RULES:
        whole = "1" if r.whole is None else r.whole
        bounds = []
        if r.low is not None:
            bounds.append(f"{r.part} >= CAST({r.low} AS DOUBLE) * {whole}")
        if r.high is not None:
            bounds.append(f"{r.part} <= CAST({r.high} AS DOUBLE) * {whole}")
        test = " AND ".join(bounds)
        tests.append(f"({test})" if r.whole is None else f"({whole} < {r.least} OR ({test}))")
    return " AND ".join(tests)


QUALITY = rf"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), each AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), places AS (
    SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o
                      || ' ' || lead(word, 4) OVER o AS five
    FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), repeated AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM places WHERE five IS NOT NULL
), covered AS (
    SELECT doc_id, sum(part) AS n FROM (
        SELECT doc_id, least(5, i - lag(i, 1, -5) OVER (PARTITION BY doc_id ORDER BY i)) AS part FROM repeated WHERE n > 1
    ) GROUP BY doc_id
), m AS (
    SELECT doc_id,
           CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) AS BIGINT) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           len(list_filter(lines, lambda x: regexp_matches(x, '(\||\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut_lines,
           len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{s}'" for s in sorted(set(STOP_WORDS)))}))) AS n_stop_words,
           len(regexp_extract_all(text, '\p{{Lu}}{{2,}}')) AS n_capital_runs,
           CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {_rules()} AS kept
FROM m
"""

JACCARD = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id,
           list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), each AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w WHERE len(words) > 2
), s AS (
    SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS shingle
        FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    ) WHERE shingle IS NOT NULL
    UNION ALL
    SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 2
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM n
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""

# Byte table of crc32, one row.
CRC_TABLE = """
crc AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                              lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
        FROM range(256) r(i)
    )
)
"""


def _crc32(text: str) -> str:
    """crc32 of the UTF-8 bytes of a text up to U+07FF; needs the table ``crc`` in the FROM clause."""
    each = "CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END"
    data = f"flatten(list_transform(string_split({text}, ''), lambda c: {each}))::BIGINT[]"
    step = "xor(x >> 8, crc.t[(xor(x, y) & 255) + 1])"
    return f"xor(list_reduce(list_concat([4294967295]::BIGINT[], {data}), lambda x, y: {step}), 4294967295)"


SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents
), kinds AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
    FROM runs WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
    SELECT run, k, {_crc32("id || ':' || run")} AS h FROM kinds, crc
), changed AS (
    SELECT CASE WHEN h % 31 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, k FROM hashed
), v AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), without AS (
    SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
), near AS (
    SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT v.word, v.n, o.word, o.n FROM v JOIN without o ON o.rest = v.word
    UNION
    SELECT o.word, o.n, v.word, v.n FROM v JOIN without o ON o.rest = v.word
), best AS (
    SELECT word, any_value(n) AS n, count(*) AS n_near, first(other ORDER BY m DESC, other) AS form, max(m) AS form_n FROM near GROUP BY word
), forms AS (
    SELECT word, form, form_n FROM best WHERE form_n >= 10 * n
), chain AS (
    SELECT word, form AS root FROM forms
    UNION ALL
    SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root
), ends AS (
    SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms)
)
SELECT v.word, forms.form, coalesce(ends.root, v.word) AS root, v.n, coalesce(best.n_near, 0) AS n_near, forms.form_n
FROM v LEFT JOIN best USING (word) LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)
"""

WARC = r"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
)
SELECT page_id,
       CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(hex, 5 * (k // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM p
WINDOW same AS (PARTITION BY html)
"""

TRIE = rf"""
WITH {CRC_TABLE}, own AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
    SELECT conv_id, turns, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own, crc
), full_ AS (
    SELECT h.conv_id, list_concat(coalesce(own.turns[1 : h.h], []), h.turns[h.h + 1 :]) AS path
    FROM h LEFT JOIN own ON own.conv_id = h.conv_id - h.conv_id % 20
), members AS (
    SELECT conv_id, len(path) AS size, d, path[1 : d] AS node FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM full_)
), nodes AS (
    SELECT node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256
    FROM members GROUP BY node, d
), kids AS (
    SELECT node[1 : depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), each AS (
    SELECT n.node, unnest(range(n.depth + 1)) AS d, CASE WHEN k.node IS NULL THEN 1 ELSE 0 END AS leaf,
           CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * len(regexp_extract_all(n.node[n.depth].x, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
    FROM nodes n LEFT JOIN kids k ON k.node = n.node
), sums AS (
    SELECT node[1 : d] AS node, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM each GROUP BY ALL
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN kids k USING (node) LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1 : n.depth - 1]
"""

SQL = {
    "op3_exact_dedup": EXACT_DEDUP, "op4_quality_rules": QUALITY, "op9_jaccard_join": JACCARD, "op11_spelling_variants": SPELLING,
    "op12_warc": WARC, "op13_conversation_trie": TRIE,
}
