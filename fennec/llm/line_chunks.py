"""Line dedup by content-defined chunks of lines.

Lines are hashed (crc32), and a rolling (polynomial) hash over the last
``window`` line hashes puts a boundary after every line where it is 0 modulo
``divisor``.  Boundaries
depend on a few neighbouring lines only, so a passage keeps its chunks wherever
it is moved to (its first ones, before the window is inside it, may differ).
Chunks of ``min_lines`` lines or more that occur elsewhere in the table are
compared byte by byte and removed, all but the first (by document id, then
position).

A passage that holds no whole chunk is found by the runs of lines at the
smallest scale: from every line the shortest run of ``min_lines`` filled lines
and ``min_chars`` characters, and one back from lines that end no such run.  A
repeated run of lines, wherever it lies, is covered by its own such runs, so
its later copies go entirely.  Runs inside a removed chunk are left out: their
copy in the first chunk stands for them.  Single lines stay, as they are too
common to judge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import pieces
from .common import let, numbered, row_key, written

WINDOW = 2
DIVISOR = 4
MIN_LINES = 2
MIN_CHARS = 40
#: Base and modulus of the rolling hash.
BASE = 1_000_003
MODULUS = (1 << 31) - 1


def _chunks(lines: Column, window: int, divisor: int) -> Column:
    """``lines`` as an array of (first line, number of lines)."""
    def cut(h: Column) -> Column:
        n = F.size(h)
        # a boundary after line i (0-based) where the rolling hash says so (null before a full window), and after the last
        ends = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == n - 1) | F.coalesce(
            sum(F.get(h, i - j) * pow(BASE, j, MODULUS) for j in range(window)) % MODULUS % divisor == 0, F.lit(False)))
        return let(ends, lambda e: F.zip_with(
            F.concat(F.array(F.lit(0)), F.transform(F.slice(e, 1, F.size(e) - 1), lambda x: x + 1)), e,
            lambda a, b: F.struct(a.alias("at"), (b - a + 1).alias("n"))))

    return let(F.transform(lines, lambda x: F.crc32(x.cast("binary")) % MODULUS), cut)


def spans(text: str, cuts: list[dict], min_lines: int, min_chars: int) -> tuple[list[np.ndarray], list[bytes]]:
    """The chunks of ``cuts`` that are large enough, and the shortest runs of
    lines: first line, number of lines, first line of the chunk around it (-1 if
    none), whether it is that chunk; and a hash of each."""
    raw = text.encode("utf-8", "surrogatepass").split(b"\n")
    lines = text.split("\n")
    chars = np.cumsum([0, *(len(x) + 1 for x in lines)])
    filled = np.cumsum([0, *(bool(x.strip()) for x in lines)])
    every = np.arange(len(lines))
    # forward: the first end with enough of both; backward: the last start with enough of both
    end = np.maximum(np.searchsorted(chars, chars[:-1] + min_chars + 1), np.searchsorted(filled, filled[:-1] + min_lines)) - 1
    s, e = every[end < len(lines)], end[end < len(lines)]
    rest = np.setdiff1d(every, e)
    back = np.minimum(np.searchsorted(chars, chars[rest + 1] - min_chars - 1, side="right"),
                      np.searchsorted(filled, filled[rest + 1] - min_lines, side="right")) - 1
    s, e = np.concatenate([s, back[back >= 0]]), np.concatenate([e, rest[back >= 0]])
    at, n = (np.array([c[x] for c in cuts]) for x in ("at", "n"))
    chunk = np.repeat(at, n)
    some = (n >= min_lines) & (chars[at + n] - chars[at] - 1 >= min_chars)
    around = np.where(chunk[s] == chunk[e], chunk[s], -1)
    short = (around < 0) | (e - s + 1 != np.repeat(n, n)[s])
    at, n = at[some], n[some]
    first, size = np.concatenate([at, s[short]]), np.concatenate([n, (e - s + 1)[short]])
    found = [first, size, np.concatenate([at, around[short]]), np.arange(len(first)) < len(at)]
    return found, [xxhash.xxh3_128_digest(b"\n".join(raw[i:i + k])) for i, k in zip(first.tolist(), size.tolist())]


def _span_rows(docs: DataFrame, min_lines: int, min_chars: int) -> DataFrame:
    """``place``, ``n``, ``c``, ``whole``, ``h`` of the spans of ``docs`` (``__id``, ``__k``, ``__t``, ``__c``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "__t"):
                found = [spans(t, c, min_lines, min_chars) for t, c in zip(texts, part.column("__c").to_pylist())]
                owner = np.repeat(np.arange(len(texts)), [len(f[1]) for f in found])
                if not len(owner):
                    continue
                at, n, c, whole = (np.concatenate([f[0][i] for f in found]) for i in range(4))
                h = np.frombuffer(b"".join(x for f in found for x in f[1]), np.int64).reshape(-1, 2)
                take = pa.array(owner, pa.int64())
                key = [pc.struct_field(part.column("__k"), x).take(take) for x in ("a", "b")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id").take(take), *key, *(pa.array(x.astype(np.int32)) for x in (at, n, c)), pa.array(whole.astype(bool)),
                     *(pa.array(np.ascontiguousarray(h[:, i])) for i in (0, 1))],
                    names=["__id", "ka", "kb", "at", "n", "c", "whole", "ha", "hb"])

    kind = docs.schema["__id"].dataType.simpleString()
    rows = docs.mapInArrow(run, f"__id {kind}, ka bigint, kb bigint, at int, n int, c int, whole boolean, ha bigint, hb bigint")
    key = F.struct(F.col("ka").alias("a"), F.col("kb").alias("b")).alias("__k")
    return rows.select(F.struct("__id", key, "at").alias("place"), "n", "c", "whole",
                       F.struct(F.col("ha").alias("a"), F.col("hb").alias("b")).alias("h"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, divisor: int = DIVISOR,
             min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``__k`` (key of id and text) and ``gone`` (array of (``at``, ``n``), ascending,
    which may overlap) for documents that lose chunks or runs.

    Only hashes are shuffled to find what repeats; texts are shuffled for the
    repeated chunks and runs alone, and partial aggregation leaves one text per
    task of a chunk that many documents share.  Within repeated rows (equal id
    and text) the first row's chunks count once, so such rows keep equal texts.
    """
    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    d = d.withColumn("__k", row_key(F.col("__id"), F.col("__t")))
    cut = d.where(F.col("__t").isNotNull()).withColumn("__c", _chunks(F.split("__t", "\n", -1), window, divisor))
    rows = written(_span_rows(cut, min_lines, min_chars), "chunk-hashes")
    # written, like both firsts: a join of two scans is one that Spark can split at a hot hash, one with an aggregate inside is not
    often = written(rows.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"), "chunk-often")
    again = written(rows.join(often, "h", "left_semi"), "chunk-again")
    # (id, key, at) is the order in which a chunk's first occurrence is found
    heads = written(again.where("whole").groupBy("h").agg(F.min("place").alias("head")), "chunk-heads")
    late = F.col("whole") & (F.col("place") != F.col("head"))
    marked = again.join(heads, "h", "left").select(F.col("place.__k").alias("__k"), "c", F.coalesce(late, F.lit(False)).alias("late"),
                                                   F.struct("place.at", "n").alias("x"), "whole")
    # in a chunk that goes its runs need not be looked at: of equal runs the first is in no such chunk
    inside = marked.groupBy("__k", "c").agg(F.max("late").alias("late"), F.collect_set("x").alias("all"),
                                            F.collect_set(F.when(F.col("whole"), F.col("x"))).alias("one"))
    wanted = inside.groupBy("__k").agg(F.flatten(F.collect_list(F.when(F.col("late"), F.col("one")).otherwise(F.col("all")))).alias("__r"))
    # byte comparison: group the repeated chunks and runs by their whole text
    # texts go into the array's elements, so that no exploded row carries the document
    own = let(F.split("__t", "\n", -1), lambda ls: F.transform("__r", lambda r: F.struct(
        r["at"].alias("at"), r["n"].alias("n"), F.array_join(F.slice(ls, r["at"] + 1, r["n"]), "\n").alias("chunk"))))
    texts = d.join(wanted, "__k").select("__id", "__k", F.explode(own).alias("__e"))
    texts = written(texts.select(F.struct("__id", "__k", "__e.at").alias("place"), "__e.n", "__e.chunk"), "chunk-texts")
    first = written(texts.groupBy("chunk").agg(F.min("place").alias("first")), "chunk-first")
    rest = texts.join(first, "chunk").where(F.col("place") != F.col("first")).select(
        F.col("place.__k").alias("__k"), F.col("place.at").alias("at"), "n").distinct()
    return rest.groupBy("__k").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("gone"))


def _dropped(gone: Column) -> Column:
    """The lines of ``gone``, each once."""
    return F.array_distinct(F.flatten(F.transform(gone, lambda g: F.sequence(g["at"], g["at"] + g["n"] - 1))))


def without(text: Column, gone: Column) -> Column:
    """``text`` without the lines of ``gone``; null ``gone`` leaves it as it is."""
    lines = F.split(text, "\n", -1)
    kept = let(_dropped(gone), lambda d: let(lines, lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), d), lambda i: F.get(ls, i)), "\n")))
    return F.when(gone.isNull(), text).otherwise(kept)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str = "__removed", **kw) -> DataFrame:
    """``docs``, all columns and rows, with ``text_col`` less its repeated chunks and runs,
    and ``removed_col`` (lines removed).

    Null texts stay null, empty ones empty; a document all of whose chunks
    repeat becomes empty.  Null ids come before others.  Columns of any other
    name are passed through.
    """
    inner, at, back = numbered(docs)
    gone = repeated(inner, at[id_col], at[text_col], **kw)
    joined = inner.withColumn("__k", row_key(F.col(at[id_col]), F.col(at[text_col]))).join(gone, "__k", "left")
    removed = F.coalesce(F.size(_dropped(F.col("gone"))), F.lit(0)).cast("bigint").alias("__removed")
    new = without(F.col(at[text_col]), F.col("gone")).alias(at[text_col])
    shown = joined.select(*[new if c == at[text_col] else F.col(c) for c in inner.columns], removed)
    return shown.select(*back, F.col("__removed").alias(removed_col))
