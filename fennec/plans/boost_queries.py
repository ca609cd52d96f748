"""Registered queries of single trees, one per way of growing, with oracles.

The matrix is the line items: quantity, discount, tax and line number have so few
values that every one of them is a border, and the label is the logarithm of the
price.  Each query grows the first tree of a member and returns its nodes; the
oracle finds the same splits with grouped and running sums.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting as B
from ..sources.tables import table
from .catalog_queries import register, rnd

DEPTH, LEAVES = 4, 6
REGULARISED = dict(growth="depth", maxDepth=3, stepSize=0.5, l1=40.0, l2=300.0, minGain=1.0, minChild=60)
LEAFWISE = dict(growth="leaf", maxDepth=DEPTH, numLeaves=LEAVES, stepSize=1.0, l1=5.0, l2=10.0, minGain=0.01, minChild=15)
OBLIVIOUS = dict(growth="oblivious", maxDepth=3, stepSize=0.25, l2=3.0)
FEATURES = ("l_quantity", "l_discount", "l_tax", "l_linenumber")


def _first_tree(spark: SparkSession, sf: str, params: dict) -> B.Booster:
    items = table(spark, sf, "lineitem").select(
        F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("features"), F.log1p(F.col("l_extendedprice").cast("double")).alias("label"))
    booster = B.Booster(B.bin_matrix(items, None, "features", "label", 256), params)
    booster.trees.append(booster.grow())
    return booster


def _nodes(spark: SparkSession, booster: B.Booster) -> DataFrame:
    """Nodes in heap numbers (children of h: 2 h + 1 and 2 h + 2)."""
    tree, rows, todo = booster.trees[0], [], [(0, 0)]
    while todo:
        node, heap = todo.pop()
        f = tree.feature[node]
        inner = f >= 0
        rows.append((heap, FEATURES[f] if inner else None, float(booster.binned.borders[f][tree.border[node]]) if inner else None,
                     float(tree.gain[node]) if inner else None, float(tree.value[node])))
        if inner:
            todo += [(tree.left[node], 2 * heap + 1), (tree.right[node], 2 * heap + 2)]
    out = spark.createDataFrame(rows, "node int, feature string, border double, gain double, weight double")
    return out.select("node", "feature", rnd("border").alias("border"), rnd("gain", 3).alias("gain"), rnd("weight").alias("weight"))


def _score(g: str, n: str, p: dict) -> str:
    l1, l2 = p.get("l1", 0.0), p.get("l2", 1.0)
    return f"(greatest(abs({g}) - {l1}, 0) * greatest(abs({g}) - {l1}, 0) / ({n} + {l2}))"


def _weight(g: str, n: str, p: dict) -> str:
    l1, l2 = p.get("l1", 0.0), p.get("l2", 1.0)
    return f"(-sign({g}) * greatest(abs({g}) - {l1}, 0) / ({n} + {l2}) * {p['stepSize']})"


def _rows_sql() -> str:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(FEATURES))
    return f"""
WITH raw AS MATERIALIZED (SELECT {cols}, ln(1 + CAST(l_extendedprice AS DOUBLE)) AS y FROM lineitem),
r0 AS MATERIALIZED (SELECT *, (SELECT avg(y) FROM raw) - y AS g, 0 AS node FROM raw)"""


def _sides_sql(level: int, p: dict) -> str:
    """Running sums of each node, feature and value, with the gain of the border there."""
    long = " UNION ALL ".join(f"SELECT node, {i} AS f, f{i} AS v, sum(g) AS g, count(*) AS n FROM r{level} GROUP BY ALL" for i in range(len(FEATURES)))
    gain = f"{_score('lg', 'ln', p)} + {_score('(tg - lg)', '(tn - ln)', p)} - {_score('tg', 'tn', p)}"
    least = max(p.get("minChild", 1), 1)
    return f"""
s{level} AS (SELECT *, sum(g) OVER w AS lg, sum(n) OVER w AS ln, sum(g) OVER (PARTITION BY node, f) AS tg, sum(n) OVER (PARTITION BY node, f) AS tn
  FROM ({long}) WINDOW w AS (PARTITION BY node, f ORDER BY v)),
e{level} AS (SELECT *, {gain} AS gain, least(ln, tn - ln) >= {least} AS ok FROM s{level})"""


def tree_sql(p: dict, leaves: int | None = None) -> str:
    parts, depth = [_rows_sql()], p["maxDepth"]
    for d in range(depth):
        parts.append(_sides_sql(d, p))
        case = " ".join(f"WHEN {i} THEN f{i}" for i in range(len(FEATURES)))
        parts.append(f"""
b{d} AS MATERIALIZED (SELECT node, f, v, gain, lg, ln, tg, tn FROM e{d} WHERE ok AND gain > {p.get('minGain', 0.0)}
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1),
r{d + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), 2 * r.node + CASE WHEN CASE b.f {case} END <= b.v THEN 1 ELSE 2 END AS node FROM r{d} r JOIN b{d} b ON b.node = r.node)""")
    splits = " UNION ALL ".join(f"SELECT node, f, v, gain FROM b{d}" for d in range(depth))
    totals = " UNION ALL ".join(f"SELECT node, sum(g) AS g, count(*) AS n FROM r{d} GROUP BY node" for d in range(depth + 1))
    parts.append(f"""
split AS ({splits}), total AS ({totals})""")
    if leaves is not None:
        # best first takes the splits whose least gain on the way from the root is highest
        parts.append(f"""
way AS (SELECT node, gain AS low, 0 AS depth FROM split WHERE node = 0
  UNION ALL SELECT s.node, least(w.low, s.gain), w.depth + 1 FROM way w JOIN split s ON (s.node - 1) // 2 = w.node AND s.node > 0),
chosen AS (SELECT way.node FROM way JOIN split USING (node) ORDER BY low DESC, depth, gain DESC LIMIT {leaves - 1}),
shown AS (SELECT * FROM split WHERE node IN (SELECT node FROM chosen))""")
    else:
        parts.append("""
shown AS (SELECT * FROM split)""")
    names = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(FEATURES))
    return ",".join(parts).replace("WITH raw", "WITH RECURSIVE raw", 1) + f"""
SELECT CAST(t.node AS INTEGER) AS node, CASE s.f {names} END AS feature, floor(s.v * 1e6 + 0.5) / 1e6 AS border,
       floor(s.gain * 1e3 + 0.5) / 1e3 AS gain, floor({_weight('t.g', 't.n', p)} * 1e6 + 0.5) / 1e6 AS weight
FROM total t LEFT JOIN shown s ON s.node = t.node
WHERE t.node = 0 OR (t.node - 1) // 2 IN (SELECT node FROM shown)"""


def oblivious_sql(p: dict) -> str:
    parts, depth = [_rows_sql()], p["maxDepth"]
    for d in range(depth):
        case = " ".join(f"WHEN {i} THEN f{i}" for i in range(len(FEATURES)))
        long = _sides_sql(d, p)
        values = " UNION ALL ".join(f"SELECT DISTINCT {i} AS f, f{i} AS v FROM raw" for i in range(len(FEATURES)))
        parts.append(long)
        # a node has no row at a value that none of its rows has: the sums of the value below hold there
        parts.append(f"""
a{d} AS (SELECT f, v, node FROM ({values}) CROSS JOIN (SELECT DISTINCT node FROM r{d})),
h{d} AS (SELECT a.f, a.v, e.gain, e.ok FROM a{d} a ASOF JOIN e{d} e ON a.node = e.node AND a.f = e.f AND a.v >= e.v),
b{d} AS MATERIALIZED (SELECT f, v, sum(CASE WHEN ok THEN gain ELSE 0 END) AS gain FROM h{d} GROUP BY ALL ORDER BY gain DESC, f, v LIMIT 1),
r{d + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), r.node + CASE WHEN CASE b.f {case} END <= b.v THEN 0 ELSE {1 << d} END AS node FROM r{d} r CROSS JOIN b{d} b)""")
    names = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(FEATURES))
    levels = " UNION ALL ".join(f"SELECT {d} AS level, f, v, gain FROM b{d}" for d in range(depth))
    return ",".join(parts) + f""",
conditions AS ({levels}),
leaf AS (SELECT node, {_weight('sum(g)', 'count(*)', p)} AS w FROM r{depth} GROUP BY node)
SELECT CAST(level AS INTEGER) AS level, CAST(NULL AS INTEGER) AS leaf, CASE f {names} END AS feature, floor(v * 1e6 + 0.5) / 1e6 AS border,
       floor(gain * 1e3 + 0.5) / 1e3 AS gain, CAST(NULL AS DOUBLE) AS weight FROM conditions
UNION ALL
SELECT NULL, CAST(n AS INTEGER), NULL, NULL, NULL, floor(coalesce(w, 0.0) * 1e6 + 0.5) / 1e6
FROM range(0, {1 << depth}) t(n) LEFT JOIN leaf ON leaf.node = n"""


@register("boost_tree_regularised", lambda: tree_sql(REGULARISED))
def q_regularised(spark, sf):
    return _nodes(spark, _first_tree(spark, sf, REGULARISED))


@register("boost_tree_leafwise", lambda: tree_sql(LEAFWISE, LEAVES))
def q_leafwise(spark, sf):
    return _nodes(spark, _first_tree(spark, sf, LEAFWISE))


@register("boost_tree_oblivious", lambda: oblivious_sql(OBLIVIOUS))
def q_oblivious(spark, sf):
    booster = _first_tree(spark, sf, OBLIVIOUS)
    tree = booster.trees[0]
    rows = [(d, None, FEATURES[f], float(booster.binned.borders[f][b]), float(g), None)
            for d, (f, b, g) in enumerate(zip(tree.features, tree.borders, tree.gains))]
    rows += [(None, i, None, None, None, float(np.float64(v))) for i, v in enumerate(tree.values)]
    out = spark.createDataFrame(rows, "level int, leaf int, feature string, border double, gain double, weight double")
    return out.select("level", "leaf", "feature", rnd("border").alias("border"), rnd("gain", 3).alias("gain"), rnd("weight").alias("weight"))
