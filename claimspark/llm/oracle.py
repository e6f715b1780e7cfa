"""DuckDB SQL of those operator queries that SQL can express."""

from __future__ import annotations

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.vec) + 1), lambda i: q.vec[i] * c.vec[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# Rates and orders are spelt with windows over all rows of a source, sums in HUGEINT.
OP11 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), c AS (
  SELECT *, CASE WHEN size > 0 THEN length(ltrim(CAST(bin(size) AS VARCHAR), '0')) ELSE 0 END AS class FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM c GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight FROM s
), shares AS (
  -- One row per round: the share of one unit of weight and the list of sources that are full.
  SELECT 0 AS turn, CAST(150 * sum(source_size) AS DOUBLE) / 100 / sum(weight) AS share, -1.0::DOUBLE AS was FROM w
  UNION ALL
  SELECT turn + 1,
         (SELECT CASE WHEN coalesce(sum(w.weight) FILTER (share * w.weight <= 2 * w.source_size), 0) = 0 THEN 0
                      ELSE (CAST(150 * sum(w.source_size) AS DOUBLE) / 100
                            - coalesce(sum(2 * w.source_size) FILTER (share * w.weight > 2 * w.source_size), 0))
                           / sum(w.weight) FILTER (share * w.weight <= 2 * w.source_size) END FROM w),
         share
  FROM shares WHERE share > was
), final AS (SELECT max(share) AS share FROM shares
), t AS (
  SELECT w.source, w.source_size,
         CASE WHEN share * weight > 2 * source_size THEN CAST(2 * source_size AS DOUBLE) ELSE share * weight END AS target
  FROM w, final
), classes AS (
  SELECT c.source, class, CAST(sum(size) AS BIGINT) AS words, any_value(target) AS target
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source WHERE class > 0 GROUP BY c.source, class
), sums AS (
  SELECT *, coalesce(sum(words) OVER up, 0)::BIGINT AS above,
         (sum(words * (class + 1)) OVER (PARTITION BY source) - coalesce(sum(words * (class + 1)) OVER up, 0))::BIGINT AS lowest
  FROM classes
  WINDOW up AS (PARTITION BY source ORDER BY class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), fills AS (
  SELECT *, (target - above * 2) / lowest AS unit,
         min(CASE WHEN (target - above * 2) / lowest * (class + 1) >= 2 THEN 1 ELSE 0 END)
           OVER (PARTITION BY source ORDER BY class DESC) AS is_full
  FROM sums
), rates AS (
  SELECT source, class, words,
         CASE WHEN is_full = 1 THEN 2.0::DOUBLE
              ELSE first_value(unit) OVER (PARTITION BY source, is_full ORDER BY class DESC) * (class + 1) END AS rate
  FROM fills
), wanted AS (
  SELECT t.source, CAST(floor(any_value(target)) AS BIGINT) - CAST(sum(CAST(floor(rate) AS BIGINT) * words) AS BIGINT) AS wanted
  FROM rates r JOIN t ON r.source IS NOT DISTINCT FROM t.source GROUP BY t.source
), keyed AS (
  SELECT c.doc_id, c.source, c.size, coalesce(rate, 0.0::DOUBLE) AS rate, CAST(floor(coalesce(rate, 0)) AS BIGINT) AS copies,
         (CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)), 1, 13)
                    AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0::DOUBLE AS u,
         rate - floor(rate) AS part
  FROM c LEFT JOIN rates r ON c.source IS NOT DISTINCT FROM r.source AND c.class = r.class
), placed AS (
  SELECT *, CASE WHEN part > 0 THEN least(CAST(floor(u * (1 - part) / (u * (1 - part) + (1 - u) * part)
                                                     * 4503599627370496.0::DOUBLE) AS BIGINT), 4503599627370495) END AS key
  FROM keyed
), ties AS (
  SELECT source, key, sum(size) AS tied FROM placed WHERE key IS NOT NULL GROUP BY source, key
), orders AS (
  SELECT *, coalesce(sum(tied) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM ties
)
SELECT p.doc_id, p.size, t.source_size, t.target,
       CAST(p.copies * p.size + CASE
         WHEN p.key IS NULL OR o.before >= w.wanted THEN 0
         WHEN o.before + o.tied < w.wanted THEN p.size
         ELSE (CAST(p.size AS HUGEINT) * (w.wanted - o.before)) // o.tied END AS BIGINT) AS taken,
       p.rate, p.copies
FROM placed p
JOIN t ON p.source IS NOT DISTINCT FROM t.source
LEFT JOIN wanted w ON p.source IS NOT DISTINCT FROM w.source
LEFT JOIN orders o ON p.source IS NOT DISTINCT FROM o.source AND p.key = o.key
"""

# A level of all trees at a time; CRC-32 is spelt bit by bit, as DuckDB has no function for it.
OP12 = r"""
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars, unnest(['d', 's', 'l', 'n', 't']) AS f,
         unnest([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text]) AS v,
         unnest([CAST(doc_id AS VARCHAR), source, lang, CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR), text]) AS forged,
         unnest([1, 2, 3, 4, 5]) AS k
  FROM documents
), docs AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(lang) AS lang,
         sha256(string_agg(coalesce(strlen(v) || ':' || v, '-'), '' ORDER BY k)) AS leaf,
         sha256(string_agg(coalesce(strlen(forged) || ':' || forged, '-'), '' ORDER BY k)) AS forged_leaf
  FROM fields GROUP BY r
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx,
         count(*) OVER (PARTITION BY lang) AS n,
         doc_id IS NOT NULL AND
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1),
               lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT))),
             lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
               lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
           4294967295::BIGINT) % 7 = 0 AS tampered
  FROM docs
), nodes AS (
  SELECT lang, 0 AS level, CAST(idx AS BIGINT) AS idx, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lang, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 2, n
), subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, CAST(idx AS BIGINT) AS idx, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
  FROM tops WHERE n > 1 GROUP BY level, idx // 2, n
), whole AS (SELECT digest AS root FROM tops WHERE n = 1
), steps AS (
  SELECT l.r, o.level, CASE WHEN s.digest IS NULL THEN '-' WHEN s.idx % 2 = 1 THEN 'R' || s.digest ELSE 'L' || s.digest END AS step
  FROM leaves l
  JOIN nodes o ON o.lang IS NOT DISTINCT FROM l.lang AND o.n > 1 AND o.idx = l.idx >> o.level
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = o.level AND s.idx = xor(o.idx, 1::BIGINT)
  UNION ALL
  SELECT l.r, 100 + o.level, CASE WHEN s.digest IS NULL THEN '-' WHEN s.idx % 2 = 1 THEN 'R' || s.digest ELSE 'L' || s.digest END
  FROM leaves l
  JOIN subroots x ON x.lang IS NOT DISTINCT FROM l.lang
  JOIN tops o ON o.n > 1 AND o.idx = CAST(x.idx AS BIGINT) >> o.level
  LEFT JOIN tops s ON s.level = o.level AND s.idx = xor(o.idx, 1::BIGINT)
), ways AS (SELECT r, list(step ORDER BY level) AS way FROM steps GROUP BY r
), folded AS (
  SELECT l.doc_id, l.leaf, x.subroot, root, sha256(list_reduce(list_concat([''], list_transform(coalesce(way, []), lambda s: substr(s, 2))),
           lambda a, b: a || b)) AS proof_sha256,
         list_reduce(list_concat([CASE WHEN tampered THEN forged_leaf ELSE l.leaf END], coalesce(way, [])),
           lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN substr(s, 2) || a ELSE a || substr(s, 2) END)) AS folded_root
  FROM leaves l JOIN subroots x ON x.lang IS NOT DISTINCT FROM l.lang CROSS JOIN whole LEFT JOIN ways USING (r)
)
SELECT *, folded_root = root AS verified FROM folded
"""

ORACLE: dict[str, str] = {"op7_vafile": OP7, "op11_pareto": OP11, "op12_postorder": OP12}
