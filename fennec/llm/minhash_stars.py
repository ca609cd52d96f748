"""Near duplicates by one-permutation MinHash, banded buckets and star-shaped edges.

A document is the set of its four-word shingles.  Documents with equal sets are
one node (copies are never paired).  One hash function deals a set's shingles into
``bands * rows`` bins and keeps the least hash of each bin; an empty bin borrows
from a bin that a hash of the bin and the attempt names, until that one is filled
(optimal densification: every empty bin borrows on its own).  Nodes that agree in
all bins of a band share a bucket.

In a bucket only the edges of a star are candidates: from one member, the hub (the
one that shares its buckets with most others), to the rest.  They are confirmed on
the full sets.  A hub is then done with, all its pairs in the bucket being known;
what remains of the bucket is needed only while its members are in several
components.  After ``STAR_ROUNDS`` rounds of this the remaining buckets, few or
none, are confirmed in blocks of bounded size as matrix products, so no link
between members of a bucket is lost, and pairs never are rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import WordCache, pieces
from .common import ASCII_LOWER, ASCII_UPPER, written
from .graph import connected_components

SHINGLE_WORDS = 4
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: A pair at 0.8 shares no bucket with probability (1 - 0.8 ** 5) ** 36, below 1e-6.
BANDS, ROWS = 36, 5
STAR_ROUNDS = 2
#: Edges of a hub, members and shingles of a block that one task gets at a time, about.
HUB_EDGES, BLOCK_NODES, BLOCK_SHINGLES = 500, 400, 500_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)
_words = WordCache(lambda new: [xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in new])


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of runs of ``size`` words (A-Z in lower case); a shorter
    text that has words is one shingle."""
    ws = _WORD.findall(text.translate(_LOWER))
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.array(_words.values_of(ws), np.uint64)
    size = min(size, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - size + 1, size, np.uint64)
        for j in range(size):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + len(out)])
    return np.unique(out)


def _borrowed(bins: int) -> Iterator[np.ndarray]:
    """For attempt 1, 2, ...: the bin that each bin would borrow from."""
    attempt = 0
    while True:
        attempt += 1
        seed = np.arange(bins, dtype=np.uint64) * np.uint64(1 << 32) + np.uint64(attempt)
        yield (_mix(_mix(seed) + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One-permutation MinHash with optimal densification, a row per set (none empty)."""
    whole = _mix(np.concatenate(sets))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    # high bits choose the bin, the whole hash is compared
    at = owner * bins + ((whole >> np.uint64(40)) % np.uint64(bins)).astype(np.int64)
    order = np.lexsort((whole, at))
    at, whole = at[order], whole[order]
    first = np.concatenate([[True], at[1:] != at[:-1]])
    out = np.zeros(len(sets) * bins, np.uint64)
    filled = np.zeros(len(sets) * bins, bool)
    out[at[first]], filled[at[first]] = whole[first], True
    out, filled = out.reshape(-1, bins), filled.reshape(-1, bins)
    todo, dense = ~filled, out.copy()
    for source in _borrowed(bins):
        if not todo.any():
            return dense
        take = todo & filled[:, source]
        dense[take] = out[:, source][take]
        todo &= ~take


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key per set and band, of the band's number and its ``rows`` bins."""
    n, bins = signature.shape
    parts = signature.reshape(n, bins // rows, rows)
    key = np.broadcast_to(np.arange(1, bins // rows + 1, dtype=np.uint64), parts.shape[:2])
    with np.errstate(over="ignore"):
        for j in range(rows):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key


def _describe(docs: DataFrame, n_bands: int, rows: int, size: int) -> DataFrame:
    """``__id``, ``__k``, ``node`` (identity of the shingle set, null without words), ``n`` (its size), ``keys``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "__t", 1_000_000):
                sets = [shingles(t, size) for t in texts]
                some = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                x, y = [None] * len(sets), [None] * len(sets)
                if some:
                    for i, row in zip(some, bands(signatures([sets[i] for i in some], n_bands * rows), rows).view(np.int64)):
                        keys[i] = row
                        x[i], y[i] = np.frombuffer(xxhash.xxh3_128_digest(sets[i].tobytes()), np.int64)
                node = pa.StructArray.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["x", "y"],
                                                  mask=pa.array([v is None for v in x]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), part.column("__k"), node, pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys, pa.list_(pa.int64()))], names=["__id", "__k", "node", "n", "keys"])

    kind = docs.schema["__id"].dataType.simpleString()
    return docs.mapInArrow(run, f"__id {kind}, __k bigint, node struct<x:bigint,y:bigint>, n bigint, keys array<bigint>")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """``node``, ``s`` (shingles) of ``node``, ``__t``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "__t", 1_000_000):
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array([shingles(t, size).view(np.int64) for t in texts], pa.list_(pa.int64()))], names=["node", "s"])

    return texts.mapInArrow(run, "node struct<x:bigint,y:bigint>, s array<bigint>")


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int, hub_edges: int) -> DataFrame:
    """Those of the distinct ``edges`` (``a``, ``b``, hub ``a``) whose sets are similar.
    A hub's edges are dealt into parts of about ``hub_edges``, each with the hub's set once."""
    edges = written(edges, "stars-edges")
    parts = edges.groupBy("a").agg(F.ceil(F.count("*") / hub_edges).cast("int").alias("parts"))
    parts = written(parts, "stars-hubs")
    dealt = edges.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"))
    members = dealt.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    hubs = parts.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a").select(
        "a", "sa", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    both = members.join(hubs, ["a", "part"])
    common = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    return both.select("a", "b", common.alias("c"), (F.size("sa") + F.size("sb")).cast("bigint").alias("t")).where(
        F.col("c") * 100 >= (F.col("t") - F.col("c")) * percent).select("a", "b")


def similar_blocks(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Boolean matrix: which sets are similar (``right`` None: the left ones among themselves, not with themselves)."""
    both = left if right is None else left + right
    sizes = np.array([len(s) for s in both], np.int64)
    owner = np.repeat(np.arange(len(both)), sizes)
    _, column, counts = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = counts[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n = len(left)
    common = np.zeros((n, len(both) - n if right is not None else n), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, 4096):
        lo, hi = np.searchsorted(column, [start, start + 4096])
        dense = np.zeros((len(both), min(4096, width - start)), np.float32)
        dense[owner[lo:hi], column[lo:hi] - start] = 1
        common += dense[:n] @ (dense[n:] if right is not None else dense).T
    shared_n = np.rint(common).astype(np.int64)
    union = sizes[:n, None] + (sizes[n:] if right is not None else sizes)[None, :] - shared_n
    out = 100 * shared_n >= percent * union
    if right is None:
        np.fill_diagonal(out, False)
    return out


def _confirmed_in_blocks(buckets: DataFrame, sets: DataFrame, percent: int, block_nodes: int, block_shingles: int) -> DataFrame:
    """Links (``a``, ``b``) between members of a bucket (``key``, ``node``), all pairs in
    blocks; of the links that a pair of blocks has, those of a spanning forest."""
    sized = buckets.join(sets.select("node", F.size("s").alias("n")), "node")
    parts = written(sized.groupBy("key").agg(F.greatest(
        F.ceil(F.count("*") / block_nodes), F.ceil(F.sum("n") / block_shingles)).cast("int").alias("blocks")), "stars-blocks")
    placed = buckets.join(parts, "key").withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), "blocks").cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    work = placed.select("key", "node", "block", F.explode(pairs).alias("p")).select("key", "node", "block", "p.i", "p.j").join(sets, "node")

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        own = (pdf["block"] == pdf["i"]).to_numpy()
        pdf = pdf.iloc[np.argsort(~own, kind="stable")]
        n, found = int(own.sum()), []
        x, y = (np.array([v[f] for v in pdf["node"]], np.int64) for f in ("x", "y"))
        sets_ = [np.asarray(s) for s in pdf["s"]]
        alone = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        if alone or 0 < n < len(sets_):
            linked = similar_blocks(sets_, None, percent) if alone else similar_blocks(sets_[:n], sets_[n:], percent)
            root = np.arange(len(sets_))
            for i, j in zip(*np.nonzero(linked)):
                j = j if alone else j + n
                while root[i] != i:
                    root[i] = i = root[root[i]]
                while root[j] != j:
                    root[j] = j = root[root[j]]
                if i != j:
                    root[max(i, j)] = min(i, j)
                    found.append((i, j))
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pd.DataFrame({"x": x[a], "y": y[a], "u": x[b], "v": y[b]})

    links = work.groupBy("key", "i", "j").applyInPandas(verify, "x bigint, y bigint, u bigint, v bigint")
    return links.select(F.struct("x", "y").alias("a"), F.struct(F.col("u").alias("x"), F.col("v").alias("y")).alias("b"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, size: int = SHINGLE_WORDS,
               n_bands: int = BANDS, rows: int = ROWS, star_rounds: int = STAR_ROUNDS, hub_edges: int = HUB_EDGES,
               block_nodes: int = BLOCK_NODES, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles`` (size of its set),
    ``component_id`` (the least id reachable over links, its own included), ``kept``
    (its id is the component's).

    Documents are linked when 100 * intersection >= ``percent`` * union of their
    shingle sets.  Null and empty texts and those without words have no shingles and
    are linked with nothing.  Null ids come first and are components' ids too; a row
    whose id is null is kept if its component's id is.  Repeated rows have equal
    sets, so share a component, and are kept alike.  Other columns are ignored.
    """
    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).withColumn("__k", F.xxhash64("__id", "__t"))
    seen = written(_describe(d, n_bands, rows, size), "stars")
    nodes = written(seen.where("node is not null").groupBy("node").agg(
        F.min(F.struct("__id", "__k")).alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys")), "stars-nodes")
    met = nodes.select("node", "n", F.explode("keys").alias("key"))
    # written: Spark can split a join of two scans at a hot bucket
    counted = written(met.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "stars-counted")
    shared = written(met.join(counted, "key"), "stars-met")
    # a node's company: how many it meets; the hub of a bucket is its member with most
    company = written(shared.groupBy("node").agg(F.sum("m").alias("company")), "stars-company")
    buckets = written(shared.join(company, "node").select(
        "key", "node", "n", F.struct("company", "node").alias("rank"), F.col("node").alias("component")), "stars-buckets")
    texts = d.select(F.col("__id").alias("__i"), F.col("__k").alias("__j"), "__t")
    wanted = company.join(nodes, "node").select("node", "first").join(
        texts, F.col("first.__id").eqNullSafe(F.col("__i")) & (F.col("first.__k") == F.col("__j")))
    # one of the repeated rows is enough
    sets = written(_sets(wanted.groupBy("node").agg(F.first("__t").alias("__t")), size), "stars-sets")
    links, member = None, None
    for round_ in range(star_rounds + 1):
        if member is not None:
            # members of a bucket that is one component need no further look
            placed = buckets.drop("component").join(member, "node", "left").withColumn("component", F.coalesce("component", "node"))
            split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
            split = written(split.select("key"), "stars-split")
            buckets = written(placed.join(split, "key", "left_semi"), "stars-buckets")
        if buckets.isEmpty():
            break
        if round_ < star_rounds:
            hubs = written(buckets.groupBy("key").agg(F.max(F.struct("rank", "n", "component")).alias("hub")).select(
                "key", F.col("hub.rank.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.component").alias("own")), "stars-hubs")
            spokes = buckets.join(hubs, "key").where("node != hub")
            buckets = spokes.select("key", "node", "n", "rank", "component")  # the hub's pairs in this bucket are settled here
            near = (F.col("component") != F.col("own")) & (F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent)
            edges = spokes.where(near).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
            new = written(_confirmed(edges, sets, percent, hub_edges), "stars-links")
        else:
            new = written(_confirmed_in_blocks(buckets.select("key", "node"), sets, percent, block_nodes, block_shingles), "stars-links")
        links = new if links is None else links.unionByName(new)
        member = connected_components(links, "stars-components")
        if round_ == star_rounds:
            break
    table = nodes.select("node", "first")
    if member is not None:
        table = table.join(member, "node", "left").withColumn("component", F.coalesce("component", "node"))
        heads = written(table.groupBy("component").agg(F.min("first.__id").alias("head"), F.max(F.col("first.__id").isNull()).alias("none")), "stars-heads")
        # a null id comes first
        heads = heads.select("component", F.when(~F.col("none"), F.col("head")).alias("head"))
        table = table.join(heads, "component").select("node", "head")
    else:
        table = table.select("node", F.col("first.__id").alias("head"))
    out = seen.select("__id", "node", "n").join(table, "node", "left")
    head = F.when(F.col("node").isNull(), F.col("__id")).otherwise(F.col("head"))
    return out.select(F.col("__id").alias(id_col), F.col("n").alias("n_shingles"), head.alias("component_id"),
                      F.col("__id").eqNullSafe(head).alias("kept"))
