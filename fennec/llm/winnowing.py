"""Benchmark decontamination by winnowing.

Every run of ``k`` words is hashed; from each window of consecutive hashes the
(leftmost) smallest is kept as a fingerprint.  A passage of ``length`` words
holds ``length - k + 1`` hashes, exactly one window, so two texts that share
such a passage share a fingerprint of it: the join on fingerprints misses
nothing.  Each joined fingerprint is then extended word by word to both sides;
runs of at least ``length`` equal words are hits, shorter ones are dropped, so
nothing that is not shared is reported.

Only DataFrame functions run here, and texts are read once for the fingerprints
of all window lengths (13 words, and fewer for shorter items) and once for the
result.  A benchmark of at most ``broadcast_rows`` fingerprints is broadcast, and the
documents' fingerprints are not shuffled; a larger one is joined by a shuffle of
two sides without aggregates, which Spark splits at a fingerprint that very many
documents or items share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, let, numbered, row_key, written

#: Everything that separates words once A-Z is lower case (fixed value).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
GRAM = 5
#: A benchmark of more fingerprints (about 200 bytes each) is not broadcast.
BROADCAST_ROWS = 100_000


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words; null gives none."""
    low = F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_LOWER)
    return F.array_remove(F.split(low, SEPARATORS), "")


def _grams(hashed: Column, k: int) -> Column:
    """Hash of each run of ``k`` words (given as hashes)."""
    rolled = let(hashed, lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - k),
        lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)])))
    return F.when(F.size(hashed) >= k, rolled).otherwise(F.array().cast("array<bigint>"))


def _kept(grams: Column, w: int) -> Column:
    """Positions of the window minima, each once, ascending."""
    def minimum(g: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(g) - w),
            lambda j: let(F.slice(g, j + 1, w), lambda s: (j + F.array_position(s, F.array_min(s)) - 1).cast("int")))

    return let(grams, lambda g: F.when(F.size(g) >= w, F.array_distinct(minimum(g))).otherwise(F.array().cast("array<int>")))


def fingerprints(df: DataFrame, keep: list[str], lengths: list[int], of: Column | None = None) -> DataFrame:
    """``keep`` + ``__n`` (window length), ``__h`` (hash), ``__p`` (position) and ``__c``,
    the hashes of the words from ``__n - k`` before to ``__n - 1`` after the position
    (null beyond the text): one row per fingerprint of ``__w`` for each of ``lengths``
    (``of``: for that one only); a text too short for all of them gives one row of nulls.

    A row carries its own neighbourhood and never the whole text, which would
    be copied once per fingerprint.
    """
    staged = df.select(*keep, F.transform("__w", lambda w: F.xxhash64(w)).alias("__wh"), *([] if of is None else [of.alias("__of")]))
    rest = [] if of is None else ["__of"]
    grams = {k: f"__g{k}" for k in sorted({min(GRAM, n) for n in lengths})}
    staged = staged.select(*keep, *rest, "__wh", *[_grams(F.col("__wh"), k).alias(g) for k, g in grams.items()])
    staged = staged.select(*keep, *rest, "__wh", *grams.values(), *[
        _kept(F.col(grams[min(GRAM, n)]), n - min(GRAM, n) + 1).alias(f"__p{n}") for n in lengths])

    def prints(n: int) -> Column:
        k = min(GRAM, n)
        ext = n - k
        nulls = F.array_repeat(F.lit(None).cast("bigint"), ext)
        found = let(F.concat(nulls, "__wh", nulls), lambda wide: let(F.col(grams[k]), lambda g: F.transform(
            f"__p{n}", lambda p: F.struct(F.lit(n).alias("n"), F.get(g, p).alias("h"), p.alias("p"), F.slice(wide, p + 1, 2 * ext + k).alias("c")))))
        return found if of is None else F.when(F.col("__of") == n, found)

    every = [prints(n) for n in lengths]
    if of is not None:
        every = [F.coalesce(*every)]
    # the outer form keeps the optimizer from adding a filter that would repeat the work above
    return staged.select(*keep, F.explode_outer(every[0] if len(every) == 1 else F.concat(*every)).alias("__f")).select(
        *keep, F.col("__f.n").alias("__n"), F.col("__f.h").alias("__h"), F.col("__f.p").alias("__p"), F.col("__f.c").alias("__c"))


def _leading(flags: Column) -> Column:
    """How many flags stand before the first false one."""
    return let(flags, lambda f: let(F.array_position(f, False).cast("int"), lambda x: F.when(x == 0, F.size(f)).otherwise(x - 1)))


def _hits(docs: DataFrame, items: DataFrame, lengths: list[int], broadcast_rows: int) -> DataFrame:
    """Spans of document words shared with items (``__len``: the words of their windows)."""
    bench = written(fingerprints(items, ["__item"], lengths, F.col("__len")).where(F.col("__h").isNotNull()).select(
        "__item", F.col("__n").alias("__in"), "__h", F.col("__c").alias("__ic")), "bench-prints")
    prints = fingerprints(docs, ["__k"], lengths)
    if bench.count() <= broadcast_rows:
        bench = F.broadcast(bench)
    k = F.least(F.lit(GRAM), F.col("__n"))
    ext = F.col("__n") - k
    same = F.zip_with("__c", "__ic", lambda a, b: F.coalesce(a == b, F.lit(False)))
    # one key of one long; equal hashes of two lengths are told apart after the join
    joined = prints.join(bench, "__h").where(F.col("__n") == F.col("__in")).select(
        "__k", "__item", "__p", "__n", k.alias("__g"), ext.alias("__e"), same.alias("__same"))
    gram = F.forall(F.slice("__same", F.col("__e") + 1, F.col("__g")), lambda x: x)
    left = _leading(F.reverse(F.slice("__same", F.lit(1), F.col("__e"))))
    right = _leading(F.slice("__same", F.col("__e") + F.col("__g") + 1, F.col("__e")))
    runs = joined.select("__k", "__item", "__p", "__n", "__g", F.when(gram, left).alias("__l"), F.when(gram, right).alias("__r"))
    return runs.where(F.col("__l") + F.col("__r") + F.col("__g") >= F.col("__n")).select(
        "__k", "__item", (F.col("__p") - F.col("__l")).alias("s"), (F.col("__p") + F.col("__g") - 1 + F.col("__r")).alias("e"))


def _covered(spans: Column) -> Column:
    """Number of positions in the union of ``spans`` (array of ``s``, ``e``)."""
    start = F.struct(F.lit(-1).alias("e"), F.lit(0).cast("bigint").alias("n"))

    def step(acc: Column, x: Column) -> Column:
        fresh = F.greatest(x["s"], acc["e"] + 1)
        return F.struct(F.greatest(acc["e"], x["e"]).alias("e"),
                        (acc["n"] + F.greatest(F.lit(0), x["e"] - fresh + 1)).alias("n"))

    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: ``__k`` (key of id and text), ``id_col``, ``n_words``,
    ``n_hit`` (words inside an occurrence of an item window), ``items`` (sorted
    distinct ids, as strings, of items with such windows).

    Null and empty texts have no words and no hits.  An item of fewer than
    ``window`` words is one window of all its words; an item without words
    matches nothing; a null item id is not listed.  Repeated rows each get
    their own result row.  Other columns are ignored, whatever their names.
    """
    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    d = d.select("__id", row_key(F.col("__id"), F.col("__t")).alias("__k"), words(F.col("__t")).alias("__w"))
    items = bench.select(F.col(item_col).cast("string").alias("__item"), words(F.col(item_text)).alias("__w"))
    items = items.withColumn("__len", F.least(F.size("__w"), F.lit(window))).where("__len > 0")
    lengths = sorted(r[0] for r in items.select("__len").distinct().collect())  # ``window`` numbers at most
    base = d.select("__k", "__id", F.size("__w").cast("bigint").alias("n_words"))
    if lengths:
        per_doc = _hits(d, items, lengths, broadcast_rows).groupBy("__k").agg(
            _covered(F.collect_set(F.struct("s", "e"))).alias("n_hit"),
            F.array_sort(F.collect_set("__item")).alias("items"))
        base = base.join(per_doc, "__k", "left")
    else:
        base = base.withColumn("n_hit", F.lit(None).cast("bigint")).withColumn("items", F.lit(None).cast("array<string>"))
    return base.select("__k", F.col("__id").alias(id_col), "n_words",
                       F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                       F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words or more are hits."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without the contaminated ones."""
    inner, at, back = numbered(docs)
    report = contamination(inner, bench, at[id_col], at[text_col], **kw)
    bad = report.where(is_contaminated(F.col("n_hit"), F.col("n_words"))).select("__k").distinct()
    keyed = inner.withColumn("__k", row_key(F.col(at[id_col]), F.col(at[text_col])))
    return keyed.join(bad, "__k", "left_anti").select(*back)
