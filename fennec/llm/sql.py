"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

DECONTAMINATION = r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
il AS (SELECT item, w, least(len(w), 13) AS n FROM iw WHERE len(w) > 0),
iwin AS (
  SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM il)),
ns AS (SELECT DISTINCT n FROM il),
dwin AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, ns WHERE len(w) >= n)),
hit AS (SELECT doc_id, dwin.n AS n, i, item FROM dwin JOIN iwin ON dwin.win = iwin.win AND dwin.n = iwin.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM dw LEFT JOIN pos ON dw.doc_id = pos.doc_id LEFT JOIN its ON dw.doc_id = its.doc_id
"""

COMPONENTS = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(len(w), 4) - 1), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS i FROM dw WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM dw UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.r),
head AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT head.doc_id AS doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, head.doc_id = component_id AS kept
FROM head LEFT JOIN n ON n.doc_id = head.doc_id
"""


def kmeans(k: int, rounds: int, dims: int, seed: int) -> str:
    """Lloyd's rounds on integers, one pair of steps a round."""
    parts = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
x AS MATERIALIZED (SELECT vec_id, unnest(range(1, {dims + 1})) AS d, unnest(v) AS v FROM kept),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM kept
          QUALIFY row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) <= {k}),
c0 AS MATERIALIZED (SELECT first.c, x.d, x.v FROM first JOIN x USING (vec_id))"""]
    for r in range(rounds + 1):
        parts.append(f"""
l{r} AS MATERIALIZED (
  SELECT vec_id, c, s FROM (SELECT x.vec_id, c.c, sum((x.v - c.v) * (x.v - c.v)) AS s FROM x JOIN c{r} c USING (d) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s, c) = 1)""")
        if r < rounds:
            parts.append(f"""
m{r} AS (SELECT l.c, x.d, sum(x.v) AS t, count(*) AS n FROM l{r} l JOIN x USING (vec_id) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
  SELECT c.c, c.d, coalesce((t - ((t % n) + n) % n) // n, c.v) AS v FROM c{r} c LEFT JOIN m{r} m ON m.c = c.c AND m.d = c.d)""")
    return ",".join(parts) + f""",
digest AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(l.c AS INTEGER) AS cluster, CAST(s AS BIGINT) AS distance,
       CAST(sum(s) OVER (PARTITION BY l.c) AS BIGINT) AS cluster_inertia, CAST(sum(s) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM l{rounds} l JOIN digest ON digest.c = l.c
"""
