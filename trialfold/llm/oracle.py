"""DuckDB forms of the queries that SQL can express, over the same tables.  The
others rest on XXH64, models, tokenizers or archives, and are tested against
plain Python."""

from __future__ import annotations

#: The table of CRC-32 as a list, ``tab.crc``.
_TABLE = """
    bits AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, 3988292384 * (x & 1))) AS v FROM range(256) t(i)),
    tab AS (SELECT list(v ORDER BY i) AS crc FROM bits)"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of code points below 2048, in UTF-8."""
    octets = (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] "
              "ELSE [(192 | (unicode(c) >> 6))::BIGINT, (128 | (unicode(c) & 63))::BIGINT] END))")
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda a, b: xor(crc[(xor(a, b) & 255) + 1], a >> 8)), 4294967295)"


EXACT_DEDUP = r"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
         g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
    FROM t JOIN g USING (body)"""

VARIANTS = f"""
    WITH RECURSIVE {_TABLE},
    run AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents)),
    counted AS (SELECT doc_id, r, count(*) AS k FROM run WHERE length(r) >= 5 GROUP BY ALL),
    hashed AS (SELECT *, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || r")} AS h FROM counted, tab),
    spelled AS (SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, k FROM hashed),
    words AS (SELECT word, sum(k)::BIGINT AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
    place AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
    less AS (SELECT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM place),
    hole AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS rest FROM place),
    pair AS (SELECT a.word, b.word AS near, b.n AS near_n FROM hole a JOIN hole b USING (rest) WHERE a.word <> b.word
             UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
             UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
    best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pair GROUP BY word),
    forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
              FROM words LEFT JOIN best USING (word)),
    chain AS (SELECT word, word AS at_word, form FROM forms
              UNION ALL SELECT c.word, c.form, f.form FROM chain c JOIN forms f ON f.word = c.form)
    SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.at_word AS root FROM forms f JOIN chain c USING (word) WHERE c.form IS NULL"""

PREFIX_TRIE = f"""
    WITH {_TABLE},
    own AS (SELECT conv_id, list({{'ref': sha256(length(r) || ':' || r || t), 'chars': length(t)}} ORDER BY turn NULLS FIRST, r, sha256(length(r) || ':' || r || t)) AS turns
            FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
    cuts AS (SELECT *, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM own, tab),
    rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS path
                FROM cuts c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
    prefix AS (SELECT conv_id, d, path[1:d] AS p, len(path) = d AS whole FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
    node AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (whole), '')) AS ends_sha256 FROM prefix GROUP BY p, d),
    kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
    own_sums AS (SELECT node.*, coalesce(n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * p[d].chars END AS saved
                 FROM node LEFT JOIN kids USING (p)),
    under AS (SELECT p[1:a] AS p, count_if(n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
              FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own_sums) GROUP BY ALL)
    SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, u.n_leaves::BIGINT AS n_leaves, u.saved_tokens, n.ends_sha256
    FROM own_sums n JOIN under u ON u.p = n.p LEFT JOIN node up ON n.d > 0 AND up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]"""

ORACLE = {"op7_exact_dedup": EXACT_DEDUP, "op11_variants": VARIANTS, "op12_prefix_trie": PREFIX_TRIE}
