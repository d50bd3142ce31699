"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

import math

_G = repr(math.log(1.02))

#: Windows of eight words are compared as text here, by hash in Spark.
QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), win AS (
  SELECT uid, i, list_aggregate(list_slice(words, i, i + 7), 'string_agg', ' ') AS g
  FROM (SELECT uid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), twice AS (
  SELECT uid, i FROM (SELECT uid, i, count(*) OVER (PARTITION BY uid, g) AS c FROM win) WHERE c > 1
), covered AS (
  SELECT uid, sum(least(8, i - prev)) AS n
  FROM (SELECT uid, i, coalesce(lag(i) OVER (PARTITION BY uid ORDER BY i), i - 8) AS prev FROM twice) GROUP BY uid
), c AS (
  SELECT w.uid, doc_id, lang, source, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered ON w.uid = covered.uid
), m AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN floor(n_symbols * 1000 / n_words) END AS symbols,
         CASE WHEN n_lines > 0 THEN floor(n_dup_lines * 1000 / n_lines) END AS dup_lines,
         CASE WHEN n_words > 0 THEN floor(n_repeat_words * 1000 / n_words) END AS repeats,
         CASE WHEN n_words > 0 THEN floor(word_chars * 100 / n_words) END AS word_len FROM c
), long AS (
  SELECT lang, source, feature, ceil(ln(x + 1) / {_G})::INT AS i
  FROM (SELECT lang, source, symbols, dup_lines, repeats, word_len FROM m WHERE NOT base_failed)
  UNPIVOT (x FOR feature IN (symbols, dup_lines, repeats, word_len))
), lv AS (
  SELECT 1 AS lv, lang, source, feature, i FROM long
  UNION ALL SELECT 2, lang, NULL, feature, i FROM long
  UNION ALL SELECT 3, NULL, NULL, feature, i FROM long
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lv, lang, source, feature ORDER BY i) AS r,
         count(*) OVER (PARTITION BY lv, lang, source, feature) AS n FROM lv
), q AS (
  SELECT lv, lang, source, feature, max(n) AS n, pow(1.02, min(CASE WHEN r * 100 >= n * 50 THEN i END)) - 1 AS q50,
         pow(1.02, min(CASE WHEN r * 100 >= n * 90 THEN i END)) - 1 AS q90 FROM ranked GROUP BY ALL
), f AS (
  SELECT lv, lang, source, feature, q90 + 3 * greatest(q90 - q50, CASE feature WHEN 'symbols' THEN 50
         WHEN 'dup_lines' THEN 150 ELSE 100 END) AS fence FROM q WHERE lv = 3 OR n >= 100
), x AS (
  SELECT uid, feature, x FROM m UNPIVOT (x FOR feature IN (symbols, dup_lines, repeats, word_len))
), odd AS (
  SELECT DISTINCT x.uid FROM x JOIN m ON m.uid = x.uid
  LEFT JOIN f AS a ON a.lv = 1 AND a.lang IS NOT DISTINCT FROM m.lang AND a.source IS NOT DISTINCT FROM m.source
       AND a.feature = x.feature
  LEFT JOIN f AS b ON b.lv = 2 AND b.lang IS NOT DISTINCT FROM m.lang AND b.feature = x.feature
  LEFT JOIN f AS e ON e.lv = 3 AND e.feature = x.feature
  WHERE x.x > coalesce(a.fence, b.fence, e.fence)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND m.uid NOT IN (SELECT uid FROM odd) AS kept FROM m
"""


#: CRC-32 of a list of bytes, with the table of the reversed polynomial made by its rule.
_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY n) AS tbl FROM (
    SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS v
    FROM range(256) t(n))
)"""
_CRC = """xor(list_reduce(list_transform(regexp_extract_all(hex(encode({})), '..'),
         lambda b: 16 * strpos('123456789ABCDEF', b[1]) + strpos('123456789ABCDEF', b[2])),
         lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"""

SHARDING = f"""
WITH RECURSIVE {_CRC_TABLE}, d AS (
  SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, '')) + 1 AS size FROM documents
), o AS (
  SELECT row_number() OVER (ORDER BY w DESC, f) AS i, t, w FROM (SELECT t, sum(size)::BIGINT AS w, min(doc_id) AS f FROM d GROUP BY t)
), r AS (
  SELECT 0::BIGINT AS i, -1::BIGINT AS shard, list_transform(range(8), lambda x: 0::BIGINT) AS loads
  UNION ALL
  SELECT o.i, list_position(loads, list_min(loads)) - 1,
         list_transform(loads, lambda x, k: CASE WHEN k = list_position(loads, list_min(loads)) THEN x + o.w ELSE x END)
  FROM r JOIN o ON o.i = r.i + 1
)
SELECT doc_id, size::BIGINT AS size, (CASE WHEN d.t = '' THEN 0 ELSE {_CRC.format("d.t")} END)::BIGINT AS text_crc32, 'bytes' AS law,
       shard::INTEGER AS shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM d JOIN o ON d.t = o.t JOIN r ON o.i = r.i CROSS JOIN crc_table
"""

TRIE = rf"""
WITH {_CRC_TABLE}, t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS at,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, n, conv_id - conv_id % 20 AS base, {_CRC.format("conv_id::VARCHAR")} % 4 AS h
  FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id) CROSS JOIN crc_table
), whole AS (
  SELECT c.conv_id, t.at + 1 AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND t.at < c.h
  UNION ALL
  SELECT c.conv_id, t.at - c.h + least(c.h, coalesce(b.n, 0)) + 1, role, text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.at >= c.h LEFT JOIN c b ON b.conv_id = c.base
), p AS MATERIALIZED (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^ 	-]+')) AS words,
         string_agg(md5(role || chr(1) || text), ',') OVER (PARTITION BY conv_id ORDER BY depth) AS node,
         coalesce(string_agg(md5(role || chr(1) || text), ',') OVER (
           PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS parent
  FROM whole
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM c
), nodes AS MATERIALIZED (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words
  FROM p GROUP BY node
), children AS (
  SELECT parent AS node, count(*) AS k FROM nodes WHERE depth > 0 GROUP BY parent
), subtrees AS (
  SELECT p.node, sum((u.n - 1) * u.words) AS saved, count(*) FILTER (children.k IS NULL) AS leaves
  FROM nodes u LEFT JOIN children ON children.node = u.node JOIN p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.node
), ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest
  FROM (SELECT conv_id, arg_max(node, depth) AS node FROM p GROUP BY conv_id) GROUP BY node
)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, nodes.n AS n_convs, coalesce(children.k, 0) AS n_children,
       subtrees.leaves AS n_leaves, subtrees.saved::BIGINT AS saved_tokens, coalesce(ends.digest, sha256('')) AS ends_sha256
FROM nodes JOIN subtrees ON subtrees.node = nodes.node LEFT JOIN children ON children.node = nodes.node
LEFT JOIN ends ON ends.node = nodes.node LEFT JOIN nodes up ON up.node = nodes.parent
"""


def _codes(rounds: int = 6) -> str:
    """Every part compared with every entry, round after round."""
    far = "list_sum(list_transform(range(1, len(x.part) + 1), lambda i: (x.part[i] - b.c[i]) * (x.part[i] - b.c[i])))::BIGINT"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT uid, x.p, min({far} * 16 + k) AS m FROM x JOIN b{r} b ON b.p = x.p GROUP BY uid, x.p
)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT p, k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
    SELECT p, k, i, sum(part[i])::BIGINT AS s, count(*) AS n FROM (
      SELECT x.p, a.m % 16 AS k, x.part, unnest(range(1, len(x.part) + 1)) AS i FROM x JOIN a{r} a ON a.uid = x.uid AND a.p = x.p)
    GROUP BY p, k, i) GROUP BY p, k
), b{r + 1} AS MATERIALIZED (
  SELECT b.p, b.k, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN m{r} m ON m.p = b.p AND m.k = b.k
)""")
    return f"""
WITH r AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS uid, vec_id, label,
         list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT uid, p, list_slice(v, p * len(v) // 8 + 1, (p + 1) * len(v) // 8) AS part FROM r, range(8) t(p)
), b0 AS (
  SELECT p, uid AS k, part AS c FROM x WHERE uid < 16
), {", ".join(steps)}, found AS (
  SELECT vec_id, label, string_agg(printf('%02x', a.m % 16), '' ORDER BY a.p) AS code, sum(a.m // 16)::BIGINT AS error
  FROM a{rounds} a JOIN r ON r.uid = a.uid GROUP BY r.uid, vec_id, label
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS sha FROM b{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256 FROM found, digest
"""


CODES = _codes()
