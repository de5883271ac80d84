"""Oracle SQL of the registered queries that SQL can express, for DuckDB."""

from __future__ import annotations

from funnelry.llm.quality_rules import STOP_WORDS

_WORD = r"[^\x20\x09-\x0D]+"

OP3 = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.r <> q.r
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 5
"""

OP8 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '{_WORD}') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l
  FROM d
), g AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM w
), c AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM g
), p AS (
  SELECT r, count(DISTINCT k) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM c WHERE n > 1) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    length(t) - length(replace(t, '!', '')) AS n_exclamations,
    len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}))) AS n_stop,
    len(l) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN p USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words <= 1000000
    AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words
    AND 100 * n_symbols <= 10 * n_words AND 100 * n_exclamations <= 30 * n_words
    AND 100 * n_stop >= 2 * n_words AND 100 * n_dup_lines <= 50 * n_lines AS kept
FROM b
"""

OP10 = r"""
WITH u AS (
  SELECT page_id, coalesce(regexp_extract(url, '://([^/?#]*)', 1), '') AS h,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), x AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    path
  FROM u
), r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
  FROM x
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN host LIKE '%casino%' OR host LIKE '%-bets.%' OR host LIKE '%cheap-pills%'
    OR host LIKE '%spam-%' OR ('.' || host) LIKE '%.adult-%'
    OR (('.' || host) LIKE '%.ads-%' AND path <> '')
    OR path LIKE '/%/wp-login.php' OR path LIKE '/%.exe' THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""

_FOLDED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

OP11 = f"""
WITH t AS (SELECT doc_id, {_FOLDED} AS x FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY x ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(x) AS text_sha256
FROM t WINDOW w AS (PARTITION BY x)
"""

OP12 = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents
), l AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CAST(len(w) < 100 AS INT) AS a, CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INT) AS b,
    CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) AS INT) AS c,
    CAST(regexp_matches(t, '[#$%&*|]') AS INT) AS d,
    CAST(coalesce(doc_id > first, false) AS INT) AS e
  FROM d LEFT JOIN l USING (doc_id)
), cells AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n, sum(good) AS good,
    sum(toxic) AS toxic
  FROM m GROUP BY ALL
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(letter, bit)
), orders AS (
  SELECT p.letter || q.letter || r.letter || s.letter || t.letter AS filter_order,
    [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
    AND len(list_distinct([p.bit, q.bit, r.bit, s.bit, t.bit])) = 5
), steps AS (
  SELECT filter_order, step, bits[step] AS bit,
    CAST(list_sum(bits[1:step]) AS INT) - bits[step] AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), totals AS (
  SELECT part, filter_order, step, bit, sum(n) FILTER (mask & (earlier | bit) = 0) AS kept,
    sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0) AS removed,
    sum(n) FILTER (mask & earlier > 0 AND mask & bit > 0) AS redundant,
    sum(n) FILTER (mask = bit) AS unique_fails,
    sum(good) FILTER (mask & earlier = 0 AND mask & bit > 0) AS good_lost,
    sum(toxic) FILTER (mask & earlier = 0 AND mask & bit > 0) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step,
  {", ".join(f"CAST(coalesce({x}, 0) AS BIGINT) AS {x}" for x in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley
FROM totals
"""


def _op13(rounds: int = 3) -> str:
    """Lloyd's rounds one after the other, each comparing all vectors with all centroids."""

    def assigned(centroids: str) -> str:
        return f"""
  SELECT r, vec_id, e, c, CAST(d AS BIGINT) AS d FROM (
    SELECT v.r, vec_id, e, c,
      list_sum(list_transform(list_zip(e, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM v, {centroids}
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1"""

    steps = []
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({assigned(f'm{i}')})")
        steps.append(f"""m{i + 1} AS MATERIALIZED (
  SELECT m{i}.c, coalesce(list(x ORDER BY k) FILTER (x IS NOT NULL), any_value(m{i}.m)) AS m
  FROM m{i} LEFT JOIN (
    SELECT c, k, sum(e[k]) // count(*) - CAST(sum(e[k]) % count(*) < 0 AS BIGINT) AS x
    FROM a{i}, (SELECT unnest(range(1, 65)) AS k) GROUP BY c, k
  ) s ON s.c = m{i}.c GROUP BY m{i}.c)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS HUGEINT)) AS e
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e AS m FROM (
    SELECT e, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, e LIMIT 16
  )
), {", ".join(steps)}, f AS ({assigned(f"m{rounds}")})
SELECT vec_id, CAST(f.c AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(list_aggregate(list_transform(m, lambda x: CAST(x AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM f JOIN m{rounds} USING (c)
"""


ORACLE: dict[str, str] = {
    "op3_top_k": OP3,
    "op8_quality_rules": OP8,
    "op10_url_globs": OP10,
    "op11_quotient_dedup": OP11,
    "op12_filter_audit": OP12,
    "op13_equal_average": _op13(),
}
