"""Corpus queries as SQL for an independent engine (DuckDB), where SQL can express them."""

from __future__ import annotations

from orderflow.llm.secrets import KINDS, MAX_OWNERS, MAX_REPOSITORIES, OPAQUE_LETTERS

# Its expressions know neither cases of ASCII alone nor looking around.
_KEYWORD = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
_PATTERNS = {
    "assign": rf"""(?:{_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "opaque": "[A-Za-z0-9+/_-]{20,}",
}


def _matches(number: int) -> str:
    kind = KINDS[number]
    pattern = _PATTERNS.get(kind.name, kind.pattern).replace("'", "''")
    return f"""SELECT row, doc_id, source, {number} AS k,
      list_transform(string_split_regex(text, '{pattern}'), lambda g: length(g)) AS gaps,
      list_transform(regexp_extract_all(text, '{pattern}', 0), lambda h: length(h)) AS sizes,
      regexp_extract_all(text, '{pattern}', {kind.group}) AS secrets
    FROM d WHERE regexp_matches(text, '{pattern}')"""


_OPAQUE = len(KINDS) - 1
_NAMES = ", ".join(f"'{kind.name}'" for kind in KINDS)
_LEAST = ", ".join(str(kind.least) for kind in KINDS)
_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE k = {i}) AS n_{kind.name}" for i, kind in enumerate(KINDS) if kind.base
)
_SPAN = "string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, k, e)"

SECRETS = f"""WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents
), m AS ({" UNION ALL ".join(_matches(i) for i in range(len(KINDS)))}
), c AS (
  SELECT row, doc_id, source, k, secrets[i] AS secret,
    (list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0))::BIGINT AS s,
    (list_sum(gaps[1:i]) + list_sum(sizes[1:i]))::BIGINT AS e
  FROM (SELECT *, unnest(range(1, len(sizes) + 1)) AS i FROM m)
), a AS (
  SELECT *, [{_NAMES}][k + 1] AS name FROM c
  WHERE length(secret) >= [{_LEAST}][k + 1]
    AND (k <> {_OPAQUE} OR regexp_matches(secret, '[0-9]') AND regexp_matches(secret, '[A-Za-z]')
         AND len(list_distinct(string_split(secret, ''))) >= {OPAQUE_LETTERS})
), o AS (
  SELECT secret, count(DISTINCT coalesce(doc_id::VARCHAR, '')) <= {MAX_REPOSITORIES}
    AND count(DISTINCT coalesce(source, '')) <= {MAX_OWNERS} AS live
  FROM a GROUP BY secret
), j AS (SELECT a.*, live FROM a JOIN o USING (secret)
), f AS (
  SELECT * FROM j WHERE k <> {_OPAQUE} OR live AND NOT EXISTS (
    SELECT 1 FROM j AS b WHERE b.row = j.row AND b.k <> {_OPAQUE} AND b.s < j.e AND j.s < b.e)
), g AS (
  SELECT row, {_COUNTS}, {_SPAN} FILTER (WHERE k <> {_OPAQUE}) AS base, {_SPAN} AS spans,
    count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example
  FROM f GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN g USING (row)"""

# The first units' lengths add up to a cut; the last unit may lack its line break.
FILL_IN_MIDDLE = """WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), u AS (
  SELECT doc_id, text, parts,
    (len(parts) - CASE WHEN parts[-1] = '' THEN 1 ELSE 0 END)::BIGINT AS n,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR h3 % 100 >= 100 OR regexp_matches(text, '<[PSM]>') THEN 'plain'
         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), e AS (
  SELECT *,
    least(coalesce(list_sum(list_transform(parts[1:a], lambda p: length(p) + 1)), 0), length(text))::BIGINT AS x,
    least(coalesce(list_sum(list_transform(parts[1:b], lambda p: length(p) + 1)), 0), length(text))::BIGINT AS y
  FROM c
), o AS (
  SELECT *, CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || substring(text, 1, x) || '<S>' || substring(text, y + 1) || '<M>' || substring(text, x + 1, y - x)
    ELSE '<S>' || substring(text, y + 1) || '<P>' || substring(text, 1, x) || '<M>' || substring(text, x + 1, y - x)
    END AS output
  FROM e
), r AS (SELECT *, string_split_regex(output, '<[PSM]>') AS q FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN y - x END AS middle_chars, sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN q[2] || q[4] || q[3]
         ELSE q[3] || q[4] || q[2] END) AS restored_sha256
FROM r"""


def _round(i: int) -> str:
    """Assignment to the centroids of round i, and the centroids after it."""
    return f"""a{i} AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS best
  FROM (SELECT v.*, c, list_sum(list_transform(range(1, 65), lambda j: (v.v[j] - m[j]) * (v.v[j] - m[j])))::BIGINT AS d
        FROM v, c{i})
  GROUP BY row
), c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(mean, m) AS m FROM c{i} LEFT JOIN (
    SELECT c, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY j) AS mean
    FROM (SELECT best.c AS c, j, sum(v[j]) AS s, count(*) AS n FROM a{i}, range(1, 65) AS t(j) GROUP BY ALL)
    GROUP BY c
  ) USING (c)
)"""


CLUSTERS = f"""WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
  FROM (SELECT sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM v ORDER BY h, v LIMIT 8)
), {", ".join(_round(i) for i in range(11))}
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
  (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a10 JOIN c10 ON best.c = c10.c"""

ORACLES = {
    "op3_secret_scans": SECRETS,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
    "op13_centroid_clustering": CLUSTERS,
}
