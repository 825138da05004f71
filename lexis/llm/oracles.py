"""DuckDB statements of the queries that SQL can express, from their definitions."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def _lowered(name: str = "text") -> str:
    return f"translate(coalesce({name}, ''), '{_UPPER}', '{_LOWER}')"


def _shingles(n: int) -> str:
    return f"list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' '))"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words(_lowered())} AS w FROM documents),
b AS (SELECT item_id, {_words(_lowered())} AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest({_shingles(5)}) AS g FROM d WHERE len(w) >= 5),
bs AS (SELECT DISTINCT item_id, unnest({_shingles(5)}) AS g FROM b WHERE len(w) >= 5),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
p AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared FROM p JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_item"""

NEAR_DEDUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(_lowered())} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN {_shingles(3)} WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
        ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 85 * (nx.n + ny.n - i)),
r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.reach = e.x)
SELECT doc_id, coalesce(max(n.n), 0) AS n_shingles, min(reach) AS component_id, doc_id = min(reach) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, unnest({_shingles(35)}) AS k FROM d WHERE len(w) >= 35),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM rep),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(cut.n, 0) AS n_removed, sha256(coalesce(kept.k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)"""


def _clusters(k: int = 8, rounds: int = 10) -> str:
    """Lloyd rounds written out one after the other over (row, dimension, component)."""
    def nearest(t: int) -> str:
        return f"""d{t} AS MATERIALIZED (SELECT r, k, sum((s.x - c.x) * (s.x - c.x)) AS dist FROM s JOIN c{t} c USING (i) GROUP BY r, k),
a{t} AS MATERIALIZED (SELECT r, min_by(k, dist * {k} + k) AS k, min(dist) AS dist FROM d{t} GROUP BY r)"""

    def moved(t: int) -> str:
        return f"""c{t + 1} AS MATERIALIZED (SELECT c.k, c.i, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN
  (SELECT k, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM s JOIN a{t} USING (r) GROUP BY k, i) m ON m.k = c.k AND m.i = c.i)"""

    steps = ",\n".join(f"{nearest(t)},\n{moved(t)}" for t in range(rounds))
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, sha256('3:' || vec_id) AS h,
  list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64),
s AS MATERIALIZED (SELECT r, unnest(range(64)) AS i, unnest(x) AS x FROM v),
c0 AS MATERIALIZED (SELECT k, unnest(range(64)) AS i, unnest(x) AS x
  FROM (SELECT row_number() OVER (ORDER BY h) - 1 AS k, x FROM v ORDER BY h LIMIT {k})),
{steps},
{nearest(rounds)},
sha AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k)
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.dist AS BIGINT) AS distance,
  CAST(sum(a.dist) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.dist) OVER () AS BIGINT) AS inertia, sha.h AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN sha ON sha.k = a.k"""


CLUSTERS = _clusters()
