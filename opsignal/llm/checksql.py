"""Check SQL of the operators whose results SQL can state, by plain listing."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

#: Unsigned CRC-32 of the decimal text of a number, from the polynomial.
_CRC = """table8 AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
 lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


def _crc(number: str) -> str:
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295)"


JACCARD = rf"""WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(w[p:p + 4], ' ')) AS s
 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM docs WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
links AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2)
 JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * common >= 80 * (p.n + q.n - common)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(n, root) AS (SELECT a, a FROM ways UNION SELECT w.b, r.root FROM reach r JOIN ways w ON w.a = r.n),
roots AS (SELECT n, min(root) AS root FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN roots r ON r.n = d.doc_id"""

SUBSTRINGS = f"""WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format('text')} AS w FROM documents),
windows AS MATERIALIZED (SELECT r, p, sha256(array_to_string(w[p:p + 34], ' ')) AS h
 FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM docs WHERE len(w) >= 35)),
twice AS (SELECT h FROM windows GROUP BY 1 HAVING count(*) > 1),
starts AS (SELECT r, p FROM windows JOIN twice USING (h)),
marked AS (SELECT r, i, w[i] AS word FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs)),
covered AS (SELECT m.r, m.i, m.word, max(CASE WHEN s.p IS NULL THEN 0 ELSE 1 END)
  OVER (PARTITION BY m.r ORDER BY m.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) = 1 AS gone
 FROM marked m LEFT JOIN starts s ON s.r = m.r AND s.p = m.i),
kept AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS rest
 FROM covered GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
 sha256(coalesce(k.rest, '')) AS kept_sha256 FROM docs d LEFT JOIN kept k USING (r)"""

TRIE = f"""WITH {_CRC},
turns AS MATERIALIZED (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER
 (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1),
heads AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % 20 AS root, {_crc('conv_id')} % 4 AS h FROM sizes, table8),
rebuilt AS (SELECT c.conv_id, t.place, t.role, t.text FROM heads c JOIN turns t ON t.conv_id = c.root AND t.place <= c.h
 UNION ALL SELECT c.conv_id, t.place - c.h + least(c.h, coalesce(s.n, 0)), t.role, t.text FROM heads c
 JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h LEFT JOIN sizes s ON s.conv_id = c.root),
lists AS (SELECT conv_id, list(sha256(concat(sha256(role), sha256(text))) ORDER BY place) AS keys,
 list(len({_WORDS.format('text')}) ORDER BY place) AS words FROM rebuilt GROUP BY 1),
whole AS (SELECT h.conv_id, coalesce(keys, []) AS keys, words FROM heads h LEFT JOIN lists USING (conv_id)),
prefixes AS MATERIALIZED (SELECT conv_id, depth, sha256(array_to_string(keys[1:depth], ',')) AS node,
 sha256(array_to_string(keys[1:depth - 1], ',')) AS up, coalesce(words[depth], 0) AS words, depth = len(keys) AS ends
 FROM (SELECT conv_id, keys, words, unnest(range(len(keys) + 1)) AS depth FROM whole)),
nodes AS MATERIALIZED (SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
 any_value(words) AS words, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ends
 FROM prefixes GROUP BY 1, 2),
children AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
own AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, node)),
below AS (SELECT p.depth, p.node, count(*) FILTER (o.n_children = 0) AS n_leaves, sum((o.n_convs - 1) * o.words) AS saved
 FROM own o JOIN prefixes p ON p.conv_id = o.conv_id AND p.depth <= o.depth GROUP BY 1, 2)
SELECT o.conv_id, o.depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children, b.n_leaves,
 CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(o.ends, '')) AS ends_sha256
FROM own o JOIN below b USING (depth, node) LEFT JOIN nodes u ON u.depth = o.depth - 1 AND u.node = o.up"""

SQL = {
    "op4_ngram_jaccard": JACCARD,
    "op11_substring_dedup": SUBSTRINGS,
    "op12_conversation_trie": TRIE,
}
