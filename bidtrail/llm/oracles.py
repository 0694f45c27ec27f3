"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from .url_rules import BLOCKED_WORDS

_WORDS = "|".join(BLOCKED_WORDS)


def _crc_entry(n: int) -> int:
    for _ in range(8):
        n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
    return n


# CRC-32 of a list of bytes, one table look-up a byte; the table follows from the polynomial.
_CRC_TABLE = f"CAST({[_crc_entry(n) for n in range(256)]} AS UBIGINT[])"


def _crc32(octets: str) -> str:
    step = f"xor(acc >> 8, {_CRC_TABLE}[CAST(xor(acc, b) & 255 AS INTEGER) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {octets}), lambda acc, b: {step}), 4294967295::UBIGINT)"


def _octets(text: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS UBIGINT))"


ORACLES = {
    "op9_url_rules": f"""
WITH split AS (
    SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, url,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM split
), ruled AS (
    SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
    END AS rule
    FROM parts
)
SELECT page_id, url, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '(^|[^a-z0-9/])({_WORDS})([^a-z0-9]|$)') THEN 'block'
    ELSE 'allow'
END AS verdict
FROM ruled
""",
    # Every 50-byte string of every document, as numbers of eight bytes each, with the first document that has it.
    "op1_suffix_dedup": """
WITH d AS (
    SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS digits FROM documents
), bytes AS (
    SELECT doc_id, len(digits) AS n, unnest(digits) AS x, unnest(range(len(digits))) AS i FROM d
), blocks AS (
    SELECT *, CAST(('0x' || string_agg(x, '') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)) AS UBIGINT) AS b FROM bytes
), strings AS (
    SELECT doc_id, i AS p, n, row(b, lead(b, 8) OVER w, lead(b, 16) OVER w, lead(b, 24) OVER w, lead(b, 32) OVER w, lead(b, 40) OVER w, lead(b, 42) OVER w) AS s
    FROM blocks WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), firsts AS (
    SELECT s, min(doc_id) AS first FROM strings WHERE p <= n - 50 GROUP BY s
), hits AS (
    SELECT doc_id, p FROM strings JOIN firsts USING (s) WHERE p <= n - 50 AND first < doc_id
), marked AS (
    SELECT b.doc_id, i, x, coalesce(max(p) OVER (PARTITION BY b.doc_id ORDER BY i) > i - 50, FALSE) AS gone
    FROM bytes b LEFT JOIN hits t ON t.doc_id = b.doc_id AND t.p = b.i
), runs AS (
    SELECT *, gone AND NOT lag(gone, 1, FALSE) OVER (PARTITION BY doc_id ORDER BY i) AS begins FROM marked
), kept AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans, string_agg(x, '' ORDER BY i) FILTER (NOT gone) AS hex_kept
    FROM runs GROUP BY doc_id
)
SELECT doc_id, CAST(len(digits) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(hex_kept, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op11_exact_dedup": r"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
""",
    # Every conversation's turns chained into one text per depth; a node is such a text, and a node's subtree are the nodes
    # whose own conversation passes through it.
    "op13_conversation_trie": rf"""
WITH t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, CAST({_crc32(_octets("CAST(conv_id AS VARCHAR)"))} % 4 AS BIGINT) AS h
    FROM (SELECT DISTINCT conv_id FROM t)
), turns AS (
    SELECT c.conv_id, 0 AS part, t.pos, role, text FROM convs c JOIN t ON t.conv_id = c.base AND t.pos <= h
    UNION ALL
    SELECT c.conv_id, 1, t.pos, role, text FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.pos > h
), placed AS (
    SELECT conv_id, row_number() OVER w AS d,
        sha256(string_agg(len(role) || ':' || len(text) || ':' || role || text, ';') OVER w) AS node,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
), path AS (
    SELECT conv_id, d, node, words FROM placed UNION ALL SELECT conv_id, 0, 'root', 0 FROM convs
), ends AS (
    SELECT conv_id, max(d) AS d FROM path GROUP BY conv_id
), nodes AS (
    SELECT d, node, min(p.conv_id) AS conv_id, count(*) AS n, any_value(words) AS words,
        coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (e.d IS NOT NULL), '') AS ids
    FROM path p LEFT JOIN ends e USING (conv_id, d) GROUP BY d, node
), parents AS (
    SELECT c.d, c.node, v.node AS parent_node, v.conv_id AS parent_conv_id
    FROM nodes c JOIN path p ON p.conv_id = c.conv_id AND p.d = c.d - 1 JOIN nodes v ON v.d = p.d AND v.node = p.node
), children AS (
    SELECT d - 1 AS d, parent_node AS node, count(*) AS n_children FROM parents GROUP BY ALL
), below AS (
    SELECT p.d, p.node, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum((u.n - 1) * u.words) AS saved
    FROM nodes u JOIN path p ON p.conv_id = u.conv_id AND p.d <= u.d LEFT JOIN children c ON c.d = u.d AND c.node = u.node
    GROUP BY p.d, p.node
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    CAST(saved AS BIGINT) AS saved_tokens, sha256(ids) AS ends_sha256
FROM nodes n JOIN below b ON b.d = n.d AND b.node = n.node LEFT JOIN parents p ON p.d = n.d AND p.node = n.node
    LEFT JOIN children c ON c.d = n.d AND c.node = n.node
""",
    # Words one error apart: one is the other without a letter, or both are the same without the letter at one place.
    "op12_spelling": rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT *, CAST({_crc32(_octets("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run"))} AS BIGINT) AS h FROM runs
), words AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), cut AS (
    SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT w.word, c.word, c.n FROM words w JOIN cut c ON c.rest = w.word
    UNION SELECT c.word, w.word, w.n FROM words w JOIN cut c ON c.rest = w.word
), best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), steps AS (
    SELECT word, word AS at, form AS next FROM formed
    UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN formed f ON f.word = s.next
)
SELECT f.word, f.form, s.at AS root, n, n_near, form_n FROM formed f JOIN steps s ON s.word = f.word AND s.next IS NULL
""",
}
