"""Substring dedup by sliding spans of sentences.

From every sentence starts a span: the shortest run of sentences of at least
``min_words`` words; a sentence that ends no such span ends one that reaches
back as far as needed.  Spans are hashed and counted over the whole table; a
sentence goes when a span over it occurs earlier (by document id, then
position).  Any passage of whole sentences with ``min_words`` words or more is
covered by its own spans, so its later copies go entirely, also those in the same
text.  Long sentences are cut into parts at places their own words decide, and a
part counts as a sentence; where a passage starts or ends amid a part, that part
stays.

A batch's texts are cut together, in arrays over all their words.  Texts stay
where they are while spans are counted: a span's row holds two 64-bit hashes and
its place.  Counts and first places are pre-aggregated, so a passage shared by any
number of documents is no hot group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import WordCache, pieces
from .common import written

MIN_WORDS = 25
#: Sentences end after words with these marks at their end, and at line ends.
MARKS = ".!?。！？"
#: Clauses end after words with these.
CLAUSE_MARKS = ",;:、，；："
#: Words on both sides among which a cut is the best place.
REACH = 5
#: Odd multipliers of the two polynomial span hashes, modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORD = re.compile(r"\S+")


def word_code(word: str) -> int:
    """A 64-bit hash of a word whose two low bits tell the marks at its end."""
    h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
    return h & ~3 | (word[-1] in MARKS) | (word[-1] in CLAUSE_MARKS) << 1


_words = WordCache(lambda new: [word_code(w) for w in new])


@dataclass
class Parts:
    """The words of some texts and the parts they are cut into: ``code`` of every
    word, ``start`` (first word of every part), and for every text its first word
    and first part (one more at the end)."""

    code: np.ndarray
    start: np.ndarray
    first_word: np.ndarray
    first_part: np.ndarray


def cut(texts: list[str]) -> Parts:
    """Sentences of the texts, long ones in parts: a cut is where the hash of two
    neighbouring words is less than those of the ``REACH`` pairs on both sides, all in
    one sentence, clause marks first.  Only these words decide, so a passage is cut
    alike wherever it stands."""
    words: list[str] = []
    lines, first = [], [0]
    for text in texts:
        for line in text.split("\n"):
            own = line.split()
            if own:
                lines.append(len(words))
                words += own
        first.append(len(words))
    code = np.array(_words.values_of(words), np.uint64)
    n = len(code)
    begins = np.zeros(n + 1, bool)
    begins[lines] = True
    begins[1:] |= (code & np.uint64(1)) == 1
    begins = begins[:n]
    if n >= 2 * REACH + 2:
        with np.errstate(over="ignore"):
            key = (code[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (code[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        # the top bit is clear after clause marks
        key = (key >> np.uint64(1)) | ((~code[:-1] & np.uint64(2)) << np.uint64(62))
        size = n - 1 - 2 * REACH
        middle = key[REACH:REACH + size]
        least = np.ones(size, bool)
        for j in range(1, REACH + 1):
            least &= (middle < key[REACH - j:REACH - j + size]) & (middle < key[REACH + j:REACH + j + size])
        sentence = np.cumsum(begins)
        least &= sentence[:size] == sentence[2 * REACH + 1:]
        begins[np.flatnonzero(least) + REACH + 1] = True
    start = np.flatnonzero(begins)
    first_word = np.array(first, np.int64)
    return Parts(code, start, first_word, np.searchsorted(start, first_word))


def bounds(text: str, starts: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) in the text of the parts that start at these words; together they are the text."""
    at = [m.start() for m in _WORD.finditer(text)]
    cuts = [0, *(at[i] for i in starts[1:].tolist()), len(text)]
    return list(zip(cuts, cuts[1:])) if len(starts) else []


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 .. n, modulo 2**64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def spans(parts: Parts, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Text, first and last part (numbered in the text) of each span, and two hashes of its words."""
    n, count = len(parts.code), len(parts.start)
    every = np.arange(count)
    text = np.searchsorted(parts.first_part, every, side="right") - 1
    low, high = parts.first_part[text], parts.first_part[text + 1]
    end = np.append(parts.start[1:], n)
    # forward: the first part with enough words; backward: the last part with enough words
    e = np.searchsorted(end, parts.start + min_words)
    ok = e < high
    s, e = every[ok], e[ok]
    rest = np.ones(count, bool)
    rest[e] = False
    rest = every[rest]
    back = np.searchsorted(parts.start, end[rest] - min_words, side="right") - 1
    ok = back >= low[rest]
    s, e = np.concatenate([s, back[ok]]), np.concatenate([e, rest[ok]])
    a, b = parts.start[s], end[e]
    hashes = []
    with np.errstate(over="ignore"):
        for base in _BASES:
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts.code * _powers(base, max(n - 1, 0))[:n], dtype=np.uint64)])
            h = (sums[b] - sums[a]) * _powers(pow(base, -1, 1 << 64), n)[a]
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xD6E8FEB86659FD93)
            hashes.append(h ^ (h >> np.uint64(32)))
    owner = text[s]
    return owner, s - parts.first_part[owner], e - parts.first_part[owner], hashes


def _span_rows(docs: DataFrame, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "__t", 1_000_000):
                owner, s, e, hashes = spans(cut(texts), min_words)
                at = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id").take(at), part.column("__k").take(at), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32)),
                     *(pa.array(h.view(np.int64)) for h in hashes)], names=["__id", "__k", "s", "e", "h", "g"])

    kind = docs.schema["__id"].dataType.simpleString()
    return docs.mapInArrow(run, f"__id {kind}, __k bigint, s int, e int, h bigint, g bigint")


def _drop(text: str, starts: np.ndarray, gone: list[dict]) -> tuple[str, int]:
    """``text`` without the parts of the spans, and how many went."""
    away = np.zeros(len(starts) + 1, np.int64)
    for g in gone:
        away[g["s"]] += 1
        away[g["e"] + 1] -= 1
    lost = np.cumsum(away[:-1]) > 0
    kept = "".join(text[a:b] for (a, b), x in zip(bounds(text, starts), lost) if not x)
    return kept.rstrip() if lost[-1] else kept, int(lost.sum())


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: ``id_col``, ``text`` without repeated passages,
    ``n_sentences``, ``n_removed`` (both count the parts of long sentences).

    Null texts stay null with no sentences, empty ones empty; a text nothing is
    removed from is returned as it is; one that is a copy becomes empty; the white
    space before an end that is removed goes with it.  Null ids come first.  Of repeated rows (equal id and text) each keeps what the
    first keeps.  Texts under ``min_words`` words have no spans.  Other columns
    are ignored.
    """
    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    d = d.withColumn("__k", F.xxhash64("__id", "__t"))
    rows = written(_span_rows(d, min_words), "spans")
    # written: a join of two scans is one that Spark can split at a hot hash, one with an aggregate inside is not
    often = written(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "spans-often")
    # the second hash tells apart what the first one confuses
    place = F.struct("__id", "__k", "s", "e").alias("place")
    # shuffle joins at every size (Spark broadcasts what it has measured to be small)
    again = rows.join(often, "h", "left_semi").select("h", "g", place)
    again = written(again, "spans-again")
    first = written(again.groupBy("h", "g").agg(F.count("*").alias("n"), F.min("place").alias("first")).where("n > 1").drop("n"), "spans-first")
    later = again.join(first, ["h", "g"]).where(F.col("place") != F.col("first"))
    gone = later.select("place.__id", "place.__k", F.struct(F.col("place.s").alias("s"), F.col("place.e").alias("e")).alias("x"))
    gone = gone.groupBy(F.col("__id").alias("__i"), F.col("__k").alias("__j")).agg(F.collect_set("x").alias("gone"))
    joined = d.join(gone, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__k") == F.col("__j")), "left").select("__id", "__t", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "__t"):
                nulls = part.column("__t").is_null().to_pylist()
                found, out = cut(texts), []
                for i, (text, null, g) in enumerate(zip(texts, nulls, part.column("gone").to_pylist())):
                    lo, hi = found.first_part[i], found.first_part[i + 1]
                    new = _drop(text, found.start[lo:hi] - found.first_word[i], g) if g else (text, 0)
                    out.append((None if null else new[0], int(hi - lo), new[1]))
                t, n, r = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), pa.array(t, pa.string()), pa.array(n, pa.int64()), pa.array(r, pa.int64())],
                    names=["__id", "text", "n_sentences", "n_removed"])

    kind = d.schema["__id"].dataType.simpleString()
    out = joined.mapInArrow(run, f"__id {kind}, text string, n_sentences bigint, n_removed bigint")
    return out.withColumnRenamed("__id", id_col)
