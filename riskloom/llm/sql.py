"""DuckDB SQL for the queries that SQL can express over whole tables."""

WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d),
k AS (SELECT *, {LOWER_AZ.format(f"trim(line, {WS})")} AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON k.key = c.key GROUP BY k.r, k.doc_id
"""


def _clustering(clusters: int = 16, rounds: int = 3) -> str:
    gap = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        """kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x FROM
  (SELECT x, sha256('1:' || vec_id) AS h FROM kept ORDER BY h, x LIMIT {clusters}))""",
    ]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (SELECT r, min(b).k AS k, min(b).d AS d FROM
  (SELECT v.r, {{'d': {gap}, 'k': c.k}} AS b FROM kept v CROSS JOIN c{n} c) GROUP BY r)""")
        if n < rounds:
            parts.append(f"""m{n} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY p) AS x FROM (
  SELECT k, p, sum(x) AS s, count(*) AS n FROM (
    SELECT a.k, unnest(v.x) AS x, generate_subscripts(v.x, 1) AS p FROM a{n} a JOIN kept v ON a.r = v.r) GROUP BY k, p) GROUP BY k),
c{n + 1} AS MATERIALIZED (SELECT c.k, CAST(coalesce(m.x, c.x) AS BIGINT[]) AS x FROM c{n} c LEFT JOIN m{n} m ON c.k = m.k)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept v ON a.r = v.r JOIN c{rounds} c ON a.k = c.k
"""


FILTER_AUDIT = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(d.doc_id > first_id, false) AS INT) AS mask
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, CAST(i AS INT) AS step, bits[i] AS bit, coalesce(list_sum(bits[1:i - 1]), 0) AS earlier
  FROM o, range(1, 6) r(i)),
x AS (SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (earlier + bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & earlier > 0 AND mask & bit > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM cells, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM x
"""

ORACLES = {"op5_line_dedup": LINE_DEDUP, "op11_centroid_clustering": _clustering(), "op12_filter_audit": FILTER_AUDIT}
