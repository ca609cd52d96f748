"""Text analysis for TF-IDF: lower-casing, accent folding, word tokens,
stop words and word n-grams, all as JVM column expressions."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .regex import WORD_CHARS

# Word tokens of two or more word characters (the default token rule).
TOKEN_PATTERN = f"[{WORD_CHARS}]{{2,}}"

# Hangul syllables (AC00-D7A3) are 19 leads x 21 vowels x 28 tails (the first one
# empty) in code point order: they are split by arithmetic, all other folds by table.
_HANGUL = (0xAC00, 0xD7A4)
_HANGUL_PATTERN = "[\uac00-\ud7a3]"
_LEAD, _VOWEL, _TAIL, _VOWELS, _TAILS = 0x1100, 0x1161, 0x11A7, 21, 28


@functools.lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, str, dict[str, str]]:
    """``(single_from, single_to, drop, multi)`` for NFKD folding without
    combining marks, built from the Unicode database by rule: characters
    folding to one character, characters of combining marks alone (deleted), and
    characters folding to several characters (ligatures, fractions, digraphs)."""
    src: list[str] = []
    dst: list[str] = []
    drop: list[str] = []
    multi: dict[str, str] = {}
    for cp in range(0x80, 0x110000):
        ch = chr(cp)
        if _HANGUL[0] <= cp < _HANGUL[1] or unicodedata.category(ch) in ("Cs", "Cn", "Co"):
            continue
        folded = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if not folded:
            drop.append(ch)
        elif folded != ch and len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif len(folded) > 1:
            multi[ch] = folded
    return "".join(src), "".join(dst), "".join(drop), multi


def accent_table() -> tuple[str, str]:
    """``(from, to)`` for ``translate``: single-character folds, then the
    combining marks (past the end of ``to``, so deleted)."""
    src, dst, drop, _ = fold_tables()
    return src + drop, dst


def multi_fold_table() -> dict[str, str]:
    return fold_tables()[3]


# a noncharacter marks rows that hold a multi-character fold
_SENTINEL = "\uffff"


def fold_fast(c: Column) -> Column:
    """One ``translate`` (a hash lookup per character): every single-character
    fold applied, combining marks deleted, and each character with a
    multi-character fold turned into a sentinel."""
    src, dst, drop, multi = fold_tables()
    keys = "".join(multi)
    return F.translate(c, src + keys + drop, dst + _SENTINEL * len(keys))


def fold_slow(c: Column) -> Column:
    """Character-by-character expansion through the multi-character map, then
    the single-character folds."""
    src, dst, drop, multi = fold_tables()
    m = F.create_map(*[F.lit(x) for kv in multi.items() for x in kv])
    expanded = F.array_join(F.transform(F.split(c, ""), lambda ch: F.coalesce(F.element_at(m, ch), ch)), "")
    return F.translate(expanded, src + drop, dst)


def choose_fold(original: Column, fast: Column) -> Column:
    """The fast result unless it holds the sentinel (rare rows)."""
    return F.when(F.instr(fast, _SENTINEL) > 0, fold_slow(original)).otherwise(fast)


def split_hangul(c: Column) -> Column:
    """Hangul syllables as their two or three letters; only texts that hold some
    are taken apart."""
    def letters(first: int, n: int) -> Column:
        return F.lit("".join(chr(first + i) for i in range(n)))

    def one(ch: Column) -> Column:
        i = F.ascii(ch) - _HANGUL[0]
        lead = F.substr(letters(_LEAD, 19), F.floor(i / (_VOWELS * _TAILS)).cast("int") + 1, F.lit(1))
        vowel = F.substr(letters(_VOWEL, _VOWELS), F.floor(i / _TAILS).cast("int") % _VOWELS + 1, F.lit(1))
        tail = F.when(i % _TAILS > 0, F.substr(letters(_TAIL, _TAILS), i % _TAILS + 1, F.lit(1))).otherwise("")
        return F.when(ch.rlike(_HANGUL_PATTERN), F.concat(lead, vowel, tail)).otherwise(ch)

    return F.when(c.rlike(_HANGUL_PATTERN), F.array_join(F.transform(F.split(c, ""), one), "")).otherwise(c)


def unless_ascii(c: Column, fold: Callable[[Column], Column]) -> Column:
    """``fold(c)``, but ASCII texts, which no fold changes, as they are."""
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(fold(c))


def fold_accents(c: Column) -> Column:
    """NFKD fold without combining marks as one expression.  Where it runs
    over large texts, project ``fold_fast`` as its own column first and then
    ``choose_fold`` (``fold_text_frame``) so the translate runs once."""
    return split_hangul(choose_fold(c, fold_fast(c)))


def fold_text_frame(df: DataFrame, text: Column, keep: list[Column], out: str = "_t", lowercase: bool = True) -> DataFrame:
    """``keep + [out]`` with ``out`` the lower-cased, accent-folded text, the
    single-character pass projected once before the per-row choice."""
    low = F.coalesce(text, F.lit(""))
    if lowercase:
        low = F.lower(low)
    staged = df.select(*keep, low.alias("_low"))
    names = [k for k in staged.columns if k != "_low"]
    staged = staged.select(*names, "_low", unless_ascii(F.col("_low"), fold_fast).alias("_fast"))
    staged = staged.select(*names, choose_fold(F.col("_low"), F.col("_fast")).alias("_folded"))
    return staged.select(*names, unless_ascii(F.col("_folded"), split_hangul).alias(out))


@functools.lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...]:
    """Spark MLlib's default English stop words, read from the package's own
    data (no JVM and no path of the PySpark installation is needed, so this
    also works when PySpark is imported from a zip archive)."""
    text = resources.files("fennec.data").joinpath("english_stop_words.txt").read_text(encoding="utf-8")
    return tuple(w for line in text.splitlines() if not line.startswith("#") for w in line.split())


def word_tokens(text: Column, lowercase: bool = True, strip_accents: bool = False) -> Column:
    t = F.coalesce(text, F.lit(""))
    if lowercase:
        t = F.lower(t)
    if strip_accents:
        t = fold_accents(t)
    return F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), F.lit(0))


def drop_stop_words(tokens: Column, stop_words: tuple[str, ...] | list[str]) -> Column:
    words = list(stop_words)
    return F.filter(tokens, lambda x: ~x.isin(words))


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined word n-grams of exactly ``n`` tokens ([] when too short).

    Built by zipping ``n`` shifted slices, so the lambdas only see their own
    arguments: the token array is evaluated a fixed number of times per row,
    never once per position, whatever the optimizer inlines.
    """
    if n == 1:
        return tokens
    m = F.size(tokens) - F.lit(n - 1)
    shifted = [F.slice(tokens, k + 1, F.greatest(m, F.lit(0))) for k in range(n)]
    acc = shifted[0]
    for nxt in shifted[1:]:
        acc = F.zip_with(acc, nxt, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(m > 0, acc).otherwise(F.array().cast("array<string>"))


def ngram_range(tokens: Column, lo: int, hi: int) -> Column:
    parts = [ngrams(tokens, n) for n in range(lo, hi + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def marked_tokens(tokens: Column, keep: list[str]) -> Column:
    """The tokens as one text, a space before each, with a line end for every
    token that is not in ``keep``."""
    marked = F.transform(tokens, lambda t: F.when(t.isin(keep), t).otherwise(F.lit("\n")))
    return F.concat(F.lit(" "), F.array_join(marked, " "))


def marked_ngrams(marked: Column, n: int) -> Column:
    """The n-grams made only of kept tokens, from ``marked_tokens``: after every
    space, the ``n`` words from there.  Project ``marked`` as its own column
    first."""
    more = r" [^ \n]++" * (n - 1)
    return F.regexp_extract_all(marked, F.lit(rf" (?=([^ \n]++{more}))"), F.lit(1))


def explode_terms(arr: Column) -> Column:
    """``explode_outer`` (callers drop the NULL row of an empty array).

    A plain ``explode`` makes the optimizer infer a ``size(arr) > 0`` filter
    and push it below the projections, which re-evaluates the whole analysis
    chain inside that filter."""
    return F.explode_outer(arr)
