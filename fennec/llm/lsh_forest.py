"""Near duplicates: n-gram Jaccard join by a MinHash LSH forest.

Texts are sets of hashed five-word shingles.  Texts with equal sets are one
node (copies are never paired).  Every node has ``TREES`` signatures, sequences
of minimum hashes; sorted, the signatures of a tree form a prefix trie.  From
the full depth on, matched prefixes are shortened until pairs at the threshold
meet in some tree with at least the target recall; nodes that share a prefix of
that length are candidates.

Candidates are joined to groups (connected components of prefix nodes), and in
each group all pairs are verified on their exact shingle sets, in blocks: a
task gets two blocks of bounded size, computes all their similarities as one
matrix product and gives back, per node, its number of links and one link
towards its cluster.  Pairs are never rows, however large a group is.
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
from .common import numbered, written
from .graph import connected_components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
TREES, DEPTH = 28, 8
#: A block of a group has at most about so many nodes and shingles.
BLOCK_NODES, BLOCK_SHINGLES = 400, 500_000
_WORD = re.compile(r"[^\W_]+")
_SEED = 20_24


def prefix_length(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """Shorten the prefix until the target recall at the threshold is reached."""
    length = depth
    while length > 1 and 1 - (1 - threshold ** length) ** trees < recall:
        length -= 1
    return length


_words = WordCache(lambda new: [xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in new])


def shingles(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of runs of ``size`` lower-cased words (letters and
    digits); a shorter text that has words is one shingle."""
    ws = _WORD.findall(text.lower())
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.array(_words.values_of(ws), np.uint64)
    size = min(size, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - size + 1, size, np.uint64)
        for j in range(size):
            out = (out ^ h[j:j + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return np.unique(out)


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    return rng.integers(0, 1 << 32, n, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32) | np.uint32(1)


def signatures(sets: list[np.ndarray], trees: int, length: int) -> np.ndarray:
    """One 64-bit hash per set and tree of the first ``length`` minimum hashes (sets are not empty)."""
    whole = np.concatenate(sets)
    low, high = whole.astype(np.uint32), (whole >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    a, b = _hash_family(TREES * DEPTH)
    out = np.empty((len(sets), trees), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(trees):
            label = np.full(len(sets), t + 1, np.uint64)
            for d in range(length):
                i = t * DEPTH + d
                least = np.minimum.reduceat(low * a[i] + high * b[i], starts)
                label = (label ^ least) * np.uint64(0xC2B2AE3D27D4EB4F)
                label ^= label >> np.uint64(31)
            out[:, t] = label
    return out


def _describe(docs: DataFrame, trees: int, length: int, size: int) -> DataFrame:
    """``__id``, ``__k``, ``node`` (identity of the shingle set), ``n`` (its size), ``labels``; null node without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "__t", 1_000_000):
                sets = [shingles(t, size) for t in texts]
                some = [i for i, s in enumerate(sets) if len(s)]
                labels: list = [None] * len(sets)
                first, second = [None] * len(sets), [None] * len(sets)
                if some:
                    for i, row in zip(some, signatures([sets[i] for i in some], trees, length).view(np.int64)):
                        labels[i] = row
                        digest = xxhash.xxh3_128_digest(sets[i].tobytes())
                        first[i], second[i] = np.frombuffer(digest, np.int64)
                node = pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["x", "y"],
                                                  mask=pa.array([x is None for x in first]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), part.column("__k"), node, pa.array([len(s) for s in sets], pa.int32()),
                     pa.array(labels, pa.list_(pa.int64()))], names=["__id", "__k", "node", "n", "labels"])

    kind = docs.schema["__id"].dataType.simpleString()
    return docs.mapInArrow(run, f"__id {kind}, __k bigint, node struct<x:bigint,y:bigint>, n int, labels array<bigint>")


def linked_pairs(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Boolean matrix: which sets are similar (``right`` None: the left ones among themselves, not with themselves)."""
    both = left if right is None else left + right
    sizes = np.array([len(s) for s in both])
    owner = np.repeat(np.arange(len(both)), sizes)
    _, column, counts = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = counts[column] > 1  # others are in no intersection
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.unique(column[order], return_inverse=True)[1]
    n = len(left)
    common = np.zeros((n, len(both) - n if right is not None else n), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, 4096):
        lo, hi = np.searchsorted(column, [start, start + 4096])
        dense = np.zeros((len(both), min(4096, width - start)), np.float32)
        dense[owner[lo:hi], column[lo:hi] - start] = 1
        common += dense[:n] @ (dense[n:] if right is not None else dense).T
    a = sizes[:n, None]
    b = (sizes[n:] if right is not None else sizes)[None, :]
    similar = common >= threshold * (a + b - common) - 1e-6
    if right is None:
        np.fill_diagonal(similar, False)
    return similar


def _roots(adjacent: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the least index of its component."""
    root = np.full(len(adjacent), -1)
    for start in range(len(adjacent)):
        if root[start] < 0:
            todo = [start]
            root[start] = start
            while todo:
                new = np.flatnonzero(adjacent[todo].any(axis=0) & (root < 0))
                root[new] = start
                todo = list(new)
    return root


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
            recall: float = RECALL, trees: int = TREES, size: int = SHINGLE_WORDS, block_nodes: int = BLOCK_NODES,
            block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document: ``__k`` (key with the id), ``id_col``, ``class_id``
    (the least id in its class of linked documents), ``first_k`` (key of that
    document), ``n_links`` (other texts similar to it: different shingle sets),
    ``n_copies`` (documents of its own shingle set, itself included).

    Null and empty texts and texts without words are similar to nothing and
    classes of their own (with one copy each).  Ties of ids are broken by the
    text's hash; repeated rows are copies.  Null ids come first.  Other columns
    are ignored.
    """
    length = prefix_length(threshold, recall, trees)
    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    d = d.withColumn("__k", F.xxhash64("__id", "__t"))
    seen = written(_describe(d, trees, length, size), "forest")
    nodes = written(seen.where("node is not null").groupBy("node").agg(
        F.min(F.struct("__id", "__k")).alias("first"), F.count("*").alias("copies"), F.max("n").alias("n"),
        F.first("labels").alias("labels")), "forest-nodes")
    met = nodes.select("node", F.posexplode("labels").alias("tree", "label"))
    # written: a join of two scans is one that Spark can split at a hot prefix, one with an aggregate inside is not
    buckets = written(met.groupBy("tree", "label").agg(F.min("node").alias("b"), F.count("*").alias("m")).where("m > 1").drop("m"), "forest-buckets")
    groups = connected_components(met.join(buckets, ["tree", "label"]).select(F.col("node").alias("a"), "b"), "forest-groups")
    groups = written(groups.join(nodes.select("node", "first", "n"), "node"), "forest-members")
    parts = written(groups.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / block_nodes), F.ceil(F.sum("n") / block_shingles)).cast("int").alias("blocks")), "forest-blocks")
    placed = groups.join(parts, "component").withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    # block pairs (i, j), i <= j: a node is in those of its own block
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    texts = d.withColumnsRenamed({"__id": "__i", "__k": "__j"})
    wanted = placed.join(texts, F.col("first.__id").eqNullSafe(F.col("__i")) & (F.col("first.__k") == F.col("__j")))
    # one of the repeated rows is enough
    wanted = wanted.groupBy("node").agg(F.first(F.struct("component", "block", "blocks", "__t")).alias("w")).select("node", "w.*")
    work = wanted.select("node", "component", "block", "__t", F.explode(pairs).alias("p")).select("*", "p.i", "p.j").drop("p")

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        own = (pdf["block"] == pdf["i"]).to_numpy()
        order = np.argsort(~own, kind="stable")
        pdf = pdf.iloc[order]
        sets = [shingles(t, size) for t in pdf["__t"]]
        n = int(own.sum())
        if n == len(sets) or n == 0:  # one block with itself, or the other one is empty
            if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
                return pd.DataFrame({"x": [], "y": [], "links": [], "rx": [], "ry": []})
            whole = linked_pairs(sets, None, threshold)
        else:
            part = linked_pairs(sets[:n], sets[n:], threshold)
            whole = np.zeros((len(sets), len(sets)), bool)
            whole[:n, n:], whole[n:, :n] = part, part.T
        links = whole.sum(axis=1)
        at = np.flatnonzero(links)
        x, y = (np.array([v[f] for v in pdf["node"]], np.int64) for f in ("x", "y"))
        # each cluster is a star around its least node
        order = np.lexsort((y, x))
        rank, least = np.empty(len(order), np.int64), np.full(len(order), len(order))
        rank[order] = np.arange(len(order))
        root = _roots(whole)
        np.minimum.at(least, root, rank)
        root = order[least[root]][at]
        return pd.DataFrame({"x": x[at], "y": y[at], "links": links[at], "rx": x[root], "ry": y[root]})

    found = work.groupBy("component", "i", "j").applyInPandas(verify, "x bigint, y bigint, links bigint, rx bigint, ry bigint")
    found = written(found.select(F.struct("x", "y").alias("a"), "links", F.struct(F.col("rx").alias("x"), F.col("ry").alias("y")).alias("b")), "forest-links")
    member = connected_components(found.select("a", "b"), "forest-classes")
    counted = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links"))
    table = nodes.select("node", "first", "copies").join(member, "node", "left").join(counted, "node", "left")
    table = table.select("node", "first", "copies", F.coalesce("component", "node").alias("class"),
                         F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
    heads = table.groupBy("class").agg(F.min("first").alias("head"))
    full = table.join(heads, "class").select("node", "head", "copies", "n_links")
    out = seen.select("__id", "__k", "node").join(full, "node", "left")
    own = F.struct("__id", "__k")
    return out.select(
        "__k", F.col("__id").alias(id_col), F.coalesce("head", own)["__id"].alias("class_id"), F.coalesce("head", own)["__k"].alias("first_k"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.coalesce("copies", F.lit(1).cast("bigint")).alias("n_copies"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, all columns as they are, less all but one (the least
    id) of each class; documents without words all stay."""
    inner, at, back = numbered(docs)
    ident, text = at[id_col], at[text_col]
    rows = written(classes(inner, ident, text, **kw), "forest-classes-of")
    heads = rows.where(F.col(ident).eqNullSafe(F.col("class_id")) & (F.col("__k") == F.col("first_k")))
    wanted = heads.select(F.col(ident).alias("__i"), F.col("__k").alias("__j")).distinct()
    keyed = inner.withColumn("__k", F.xxhash64(ident, text))
    kept = keyed.join(wanted, F.col(ident).eqNullSafe(F.col("__i")) & (F.col("__k") == F.col("__j")), "left_semi")
    again = heads.where("n_copies > 1").groupBy(ident, "__k").count().where("count > 1")
    if not again.isEmpty():  # repeated rows: equal id and text
        has_words = F.regexp_extract(F.lower(text), r"[\p{L}\p{N}]", 0) != ""
        some = kept.where(has_words).dropDuplicates([ident, text])
        kept = some.unionByName(kept.where(F.coalesce(~has_words, F.lit(True))))
    return kept.select(*back)
