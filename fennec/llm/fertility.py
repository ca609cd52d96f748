"""Quality rules from tokeniser fertility.

Public vocabularies are run over the words of every text: characters per token
(of two vocabularies), the share of byte-fallback tokens and the entropy of the
tokens.  Shouting, symbol soup, repeated words, encoded data and foreign
scripts move these figures away from what is usual in their language.  Words
with a digit are left out of these figures (numbers are split digit by digit,
whatever the language).  The usual is the median over all documents of the same language (or of the same
script where the language is null); a document is rejected where a figure
leaves the band around the median, whose width is a number of median absolute
deviations of that figure in that group.  These numbers are parameters.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_dim
from .arrow import WordCache, pieces
from .common import written

#: White space between words and the counted symbols (fixed values).
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: First and last code points of scripts (fixed values).
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x6FF), ("devanagari", 0x900, 0x97F), ("thai", 0xE00, 0xE7F), ("kana", 0x3040, 0x30FF),
    ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7A3),
)


@dataclass(frozen=True)
class Bands:
    """Rejection bands around the group's medians: widths in median absolute
    deviations, which count as ``floor_chars`` or ``floor_entropy`` of the median
    at least (copies of one document have none).  Groups of fewer than
    ``min_group`` documents have no spread to speak of; theirs are the wide ones
    from ``chars_low`` on, relative to the medians."""

    chars: float = 10.0
    chars_2_low: float = 6.0
    chars_2_high: float = 8.0
    entropy: float = 6.0
    floor_chars: float = 0.005
    floor_entropy: float = 0.012
    min_group: int = 30
    chars_low: float = 0.86
    chars_high: float = 1.2
    entropy_low: float = 0.8
    entropy_high: float = 1.3
    fallback_max: float = 0.10


def _paths() -> tuple[str, str, str]:
    import public_tokenizers

    return (public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
            public_tokenizers.PATTERN)


@functools.lru_cache(maxsize=2)
def _vocabularies(pieces_path: str, ranks_path: str, pattern: str):
    """The two tokenizers, the byte pieces' mask and a cache of words (one per worker)."""
    import sentencepiece
    import tiktoken

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
    with open(ranks_path, "rb") as fh:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
    words = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    is_byte = np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])

    def compute(new: list[str]) -> list[tuple[bytes, int]]:
        ids = sp.encode(new, num_threads=1)
        return [(np.array(i, np.uint16).tobytes(), len(words.encode_ordinary(" " + w))) for w, i in zip(new, ids)]

    return is_byte, WordCache(compute)


def repeated_words(code: np.ndarray) -> int:
    """Words (numbered) inside windows of three words that occur twice or more."""
    if len(code) < 4:
        return 0
    n = int(code.max()) + 1
    _, pair = np.unique(code[:-2] * n + code[1:-1], return_inverse=True)
    _, where, counts = np.unique(pair * n + code[2:], return_inverse=True, return_counts=True)
    twice = counts[where] > 1
    if not twice.any():
        return 0
    covered = np.zeros(len(code), bool)
    for shift in range(3):
        covered[shift:shift + len(twice)] |= twice
    return int(covered.sum())


def line_and_symbol_counts(text: str) -> tuple[int, int]:
    """n_symbols, n_dup_lines."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))


def number_words(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of all texts, each word's number among them, and where each text's words begin and end."""
    parts = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
    counts, parts = np.asarray(pc.list_value_length(parts)), parts.flatten()
    filled = np.asarray(pc.greater(pc.binary_length(parts), 0))  # the ends of a text give empty parts
    owner = np.repeat(np.arange(len(texts)), counts)[filled]
    coded = parts.filter(pa.array(filled)).dictionary_encode()
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
    return coded.dictionary, np.asarray(coded.indices).astype(np.int64), bounds


def script_of(text: str) -> str:
    """The script of most letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = [(int(((points >= lo) & (points <= hi)).sum()), name) for name, lo, hi in SCRIPTS]
    most = max(counts)
    return most[1] if most[0] else "other"


_SCHEMA = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "n_tokens bigint, chars_per_token double, chars_per_token_2 double, fallback_share double, token_entropy double, "
           "band_group string")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            paths: tuple[str, str, str] | None = None) -> DataFrame:
    """Per document: ``id_col``, the base counts and the vocabularies' figures
    (null without words that have no digit)."""
    paths = paths or _paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_byte, cache = _vocabularies(*paths)
        for batch in batches:
            for part, texts in pieces(batch, "__t"):
                words, code, bounds = number_words(texts)
                chars = np.asarray(pc.utf8_length(words)).astype(np.int64)
                plain = ~np.asarray(pc.match_substring_regex(words, r"\p{Nd}"))  # without a digit
                got = cache.values_of(words.filter(pa.array(plain)).to_pylist())
                number = np.cumsum(plain) - 1  # among the plain words
                count = np.fromiter((len(g[0]) // 2 for g in got), np.int64, len(got))
                count_2 = np.fromiter((g[1] for g in got), np.int64, len(got))
                flat, start = np.frombuffer(b"".join([g[0] for g in got]), np.uint16), np.concatenate([[0], np.cumsum(count)])[:-1]
                rows = []
                for i, (text, lang) in enumerate(zip(texts, part.column("__l").to_pylist())):
                    own = code[bounds[i]:bounds[i + 1]]
                    base = (len(own), int(chars[own].sum()), *line_and_symbol_counts(text), repeated_words(own))
                    group = lang if lang is not None else "script:" + script_of(text)
                    used = own[plain[own]]
                    if not len(used):
                        rows.append((*base, 0, None, None, None, None, group))
                        continue
                    k = number[used]
                    n = count[k]
                    first = np.cumsum(n) - n
                    ids = flat[np.repeat(start[k] - first, n) + np.arange(int(n.sum()))]
                    seen = np.bincount(ids)
                    p = seen[seen > 0] / len(ids)
                    total = int(chars[used].sum())
                    rows.append((*base, len(ids), total / len(ids), total / int(count_2[k].sum()),
                                 float(is_byte[ids].mean()), float(-(p * np.log2(p)).sum()), group))
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 6 + [pa.float64()] * 4 + [pa.string()])]
                names = [x.split()[0] for x in _SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([part.column("__id"), *cols], names=["__id", *names])

    d = docs.select(F.col(id_col).alias("__id"), F.col(lang_col).cast("string").alias("__l"), F.col(text_col).alias("__t"))
    out = d.mapInArrow(run, f"__id {d.schema['__id'].dataType.simpleString()}, {_SCHEMA}")
    return out.withColumnRenamed("__id", id_col)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          bands: Bands = Bands(), min_words: int = 50, max_repeat_pct: int = 50,
          paths: tuple[str, str, str] | None = None) -> DataFrame:
    """``measure`` with ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base rule.  Documents that
    fail it don't take part in the medians and spreads, which are over all others.  Repeated
    rows are measured and judged row by row; other columns are ignored.
    """
    m = written(measure(docs, id_col, text_col, lang_col, paths), "fertility")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)
    m = m.withColumn("base_failed", failed)
    figures = {"m1": "chars_per_token", "m2": "chars_per_token_2", "mh": "token_entropy"}
    usual = written(
        m.where(~F.col("base_failed")).groupBy("band_group").agg(
            F.count("*").alias("size"), *[F.percentile_approx(c, 0.5, 10_000).alias(x) for x, c in figures.items()]), "fertility-medians")
    groups = usual.count()
    spread = written(
        join_dim(m.where(~F.col("base_failed")), usual, "band_group", known_rows=groups, max_rows=100_000).groupBy("band_group").agg(
            *[F.first(x).alias(x) for x in ("size", *figures)],
            *[F.percentile_approx(F.abs(F.col(c) - F.col(x)), 0.5, 10_000).alias(f"s{x}") for x, c in figures.items()]), "fertility-bands")
    j = join_dim(m, spread, "band_group", known_rows=groups, max_rows=100_000)

    def inside(x, below, above, floor, lo, hi):
        col, mid = F.col(figures[x]), F.col(x)
        unit = F.greatest(F.col(f"s{x}"), mid * floor)
        wide = F.col("size") < bands.min_group
        return (col >= F.when(wide, mid * lo).otherwise(mid - unit * below)) & (col <= F.when(wide, mid * hi).otherwise(mid + unit * above))

    good = (inside("m1", bands.chars, bands.chars, bands.floor_chars, bands.chars_low, bands.chars_high)
            & inside("m2", bands.chars_2_low, bands.chars_2_high, bands.floor_chars, bands.chars_low, bands.chars_high)
            & inside("mh", bands.entropy, bands.entropy, bands.floor_entropy, bands.entropy_low, bands.entropy_high)
            & (F.col("fallback_share") <= bands.fallback_max))
    return j.withColumn("kept", F.coalesce(~F.col("base_failed") & good, F.lit(False))).drop("size", *figures, *(f"s{x}" for x in figures))
