"""Exact grouped quantiles without holding a group in one task.

``percentile``/``median`` keep a value->count map per group and merge it in
one task, so one hot group (or a global quantile) with many distinct values
lands whole in one task.  ``exact_quantiles`` gives the same interpolated
result by histogram refinement instead:

1. per group: ``n``, ``min``, ``max`` (one partial-aggregated shuffle); the
   needed order statistics are ranks ``floor((n-1)p)`` and ``ceil((n-1)p)``.
2. each unresolved rank has a closed value interval ``[a, b]`` and the number
   of the group's values below ``a``.  One pass buckets the values inside the
   active intervals and counts them (map-side partial aggregation, so a
   shuffle carries at most intervals x bins rows).  The rank's bucket becomes
   the new interval ``[bucket min, bucket max]``; buckets are monotone in the
   value, so the interval holds exactly that bucket's values.
3. a rank is resolved when its interval holds one distinct value, or when it
   holds at most ``small`` values: those are then sorted in one task each
   (bounded by ``small``).

The buckets make the number of rounds a constant whatever the values are:
an interval across zero or up to an infinity is first cut by sign and
infinity; one whose ends differ by more than a factor of two is cut in equal
steps of the logarithm (the exponents of all doubles fit in one such round);
any other holds at most 2**53 doubles and is cut in equal widths, which leaves
none undivided after five rounds of 4096 bins.

Values are never shuffled by key: the groups above ``small`` values are at most
a ``small``-th of the rows in number, and that list is what is joined.  Each
round is a scan of the input filtered to the active intervals; the small
interval tables are checkpointed to the session's checkpoint folder between
rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_dim

DEFAULT_BINS = 4096
DEFAULT_SMALL = 50_000
# "refine": exact, no group held in one task (default)
# "aggregate": Spark's one-pass ``percentile`` (exact; fine when every group
#              has few distinct values)
DEFAULT_MODE = "refine"


def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): the folder is the session's
    shared ``spark.checkpoint.dir``."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    keys: list[str] | tuple[str, ...] = (),
    bins: int | None = None,
    small: int | None = None,
    out: str = "q",
    write_input: bool = True,
) -> DataFrame:
    """``(keys..., out)`` with ``out`` = array of the exact interpolated
    quantiles at ``probs`` (NULL values are skipped; empty groups are absent).

    ``write_input=False`` when ``df`` is already a cheap scan of a written
    table: refinement rounds then re-read it instead of writing a copy."""
    bins = DEFAULT_BINS if bins is None else bins
    small = DEFAULT_SMALL if small is None else small
    keys = list(keys)
    if not keys:
        df = df.withColumn("_g", F.lit(0))
        gkeys = ["_g"]
    else:
        gkeys = keys
    vals = df.select(*gkeys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))

    sizes = vals.groupBy(*gkeys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    largest = sizes.agg(F.max("_n")).first()[0] or 0
    pct = F.percentile("_v", [float(p) for p in probs]).alias(out)
    if largest <= small:
        # every group has at most `small` values: one-pass exact percentile,
        # whose buffer is bounded by the group size
        res = vals.groupBy(*gkeys).agg(pct)
        return res.drop("_g") if not keys else res
    big = _cut(sizes.where(F.col("_n") > F.lit(small)))
    n_big = big.count()
    names = big.select(*gkeys)
    rest = join_dim(vals, names, gkeys, "left_anti", known_rows=n_big)
    hot = join_dim(vals, names, gkeys, "left_semi", known_rows=n_big)
    big_res = _refine(hot, big, gkeys, probs, bins, small, out, write_input)
    res = rest.groupBy(*gkeys).agg(pct).unionByName(big_res)
    return res.drop("_g") if not keys else res


def _bucket(v: Column, a: Column, b: Column, bins: int) -> Column:
    """Bucket of ``v`` in ``[a, b]``: monotone in ``v`` (so is the logarithm, by
    the platform's definition)."""
    inf = F.lit(float("inf"))
    sign = F.when(v == -inf, 0).when(v < 0, 1).when(v == 0, 2).when(v < inf, 3).otherwise(4)

    def steps(x: Column, lo: Column, hi: Column) -> Column:
        return F.least(F.floor((x - lo) / ((hi - lo) / F.lit(float(bins)))), F.lit(bins - 1)).cast("int")

    one_sign = ((a > 0) & (b < inf)) | ((b < 0) & (a > -inf))
    wide = (F.abs(a) > F.abs(b) * 2) | (F.abs(b) > F.abs(a) * 2)
    log = F.when(a > 0, steps(F.log(v), F.log(a), F.log(b))).otherwise(steps(-F.log(-v), -F.log(-a), -F.log(-b)))
    return F.when(~one_sign, sign).when(wide, log).otherwise(steps(v, a, b))


def _refine(vals: DataFrame, base: DataFrame, gkeys: list[str], probs: list[float], bins: int, small: int,
            out: str, write_input: bool = True) -> DataFrame:
    """Histogram refinement for the groups in ``base`` (``_n``, ``_a``, ``_b``)."""
    if write_input:
        # every round re-reads the values: write the narrow (keys, value) input once
        vals = _cut(vals)
    pos = [F.struct(F.lit(i).alias("__pi"), ((F.col("_n") - 1).cast("double") * F.lit(float(p))).alias("__h")) for i, p in enumerate(probs)]
    targets = base.select(*gkeys, "_n", "_a", "_b", F.explode(F.array(*pos)).alias("__t")).select(
        *gkeys, "_a", "_b", F.col("__t.__pi").alias("__pi"), F.col("__t.__h").alias("__h")
    )
    targets = _cut(targets)
    ranks = targets.select(*gkeys, "_a", "_b", F.explode(F.array_distinct(F.array(F.floor("__h"), F.ceil("__h")))).alias("__rank")).distinct()
    # cells: (keys, rank, a, b, off) -> value once resolved
    cells = _cut(ranks.select(*gkeys, F.col("__rank").cast("long").alias("__rank"), F.col("_a").alias("__a"), F.col("_b").alias("__b"),
                              F.lit(0).cast("long").alias("__off"), F.when(F.col("_a") == F.col("_b"), F.col("_a")).alias("__res"),
                              F.lit(False).alias("__final")))

    while True:
        active = cells.where(F.col("__res").isNull() & ~F.col("__final"))
        intervals = _cut(active.select(*gkeys, "__a", "__b").distinct())
        n_int = intervals.count()
        if n_int == 0:
            break
        inside = join_dim(vals, intervals, gkeys, "inner", known_rows=n_int).where((F.col("_v") >= F.col("__a")) & (F.col("_v") <= F.col("__b")))
        bucket = _bucket(F.col("_v"), F.col("__a"), F.col("__b"), bins)
        hist = inside.groupBy(*gkeys, "__a", "__b", bucket.alias("_bk")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_bmin"), F.max("_v").alias("_bmax")
        )
        w = Window.partitionBy(*gkeys, "__a", "__b").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("_below", F.coalesce(F.sum("_c").over(w), F.lit(0)))
        step = active.join(hist, gkeys + ["__a", "__b"]).where(
            (F.col("__rank") - F.col("__off") >= F.col("_below")) & (F.col("__rank") - F.col("__off") < F.col("_below") + F.col("_c"))
        ).select(
            *gkeys, "__rank",
            F.col("_bmin").alias("__a"), F.col("_bmax").alias("__b"), (F.col("__off") + F.col("_below")).alias("__off"),
            F.when(F.col("_bmin") == F.col("_bmax"), F.col("_bmin")).alias("__res"),
            ((F.col("_bmin") != F.col("_bmax")) & (F.col("_c") <= F.lit(small))).alias("__final"),
        )
        done = cells.where(F.col("__res").isNotNull() | F.col("__final"))
        cells = _cut(done.unionByName(step))

    # final cells: sort their (at most `small`) values and pick the local rank
    fin = cells.where(F.col("__res").isNull() & F.col("__final"))
    fin_int = fin.select(*gkeys, "__a", "__b").distinct()
    n_fin = fin_int.count()
    if n_fin:
        picked_vals = (
            join_dim(vals, fin_int, gkeys, "inner", known_rows=n_fin)
            .where((F.col("_v") >= F.col("__a")) & (F.col("_v") <= F.col("__b")))
            .groupBy(*gkeys, "__a", "__b").agg(F.sort_array(F.collect_list("_v")).alias("_vals"))
        )
        fin = fin.join(picked_vals, gkeys + ["__a", "__b"]).select(
            *gkeys, "__rank", F.element_at("_vals", (F.col("__rank") - F.col("__off") + 1).cast("int")).alias("__res")
        )
        resolved = cells.where(F.col("__res").isNotNull()).select(*gkeys, "__rank", "__res").unionByName(fin)
    else:
        resolved = cells.select(*gkeys, "__rank", "__res")

    lo = resolved.select(*gkeys, F.col("__rank").alias("_lo"), F.col("__res").alias("v_lo"))
    hi = resolved.select(*gkeys, F.col("__rank").alias("_hi"), F.col("__res").alias("v_hi"))
    t = targets.withColumn("_lo", F.floor("__h").cast("long")).withColumn("_hi", F.ceil("__h").cast("long"))
    t = t.join(lo, gkeys + ["_lo"]).join(hi, gkeys + ["_hi"])
    frac = F.col("__h") - F.col("_lo").cast("double")
    qv = F.when((F.col("_lo") == F.col("_hi")) | (F.col("v_lo") == F.col("v_hi")), F.col("v_lo")).otherwise(
        (F.col("_hi").cast("double") - F.col("__h")) * F.col("v_lo") + frac * F.col("v_hi")
    )
    res = t.groupBy(*gkeys).agg(F.sort_array(F.collect_list(F.struct("__pi", qv.alias("__q")))).alias("_qs"))
    return res.select(*gkeys, F.transform("_qs", lambda s: s["__q"]).alias(out))


def exact_median(df: DataFrame, value: str, keys: list[str] | tuple[str, ...] = (), out: str = "median", **kw) -> DataFrame:
    q = exact_quantiles(df, value, [0.5], keys, out="_q", **kw)
    return q.select(*keys, F.col("_q")[0].alias(out))


def group_median(df: DataFrame, value: str, keys: list[str], out: str, mode: str | None = None,
                 write_input: bool = True) -> DataFrame:
    """``(keys..., out)``: exact median per group by the chosen strategy."""
    if (mode or DEFAULT_MODE) == "aggregate":
        return df.groupBy(*keys).agg(F.median(F.col(value).cast("double")).alias(out))
    return exact_median(df, value, keys, out, write_input=write_input)


def complement_medians(
    df: DataFrame,
    value: str,
    fold: str,
    keys: list[str],
    n_folds: int,
    bins: int | None = None,
    small: int | None = None,
    out: str = "median",
) -> DataFrame:
    """``(keys..., h, out)``: the exact median of a group's values outside fold
    ``h``, for every ``h`` of ``0 .. n_folds - 1`` that leaves a value (NULL and
    NaN are skipped).  ``df`` is a scan of a written table.

    No row is copied to the folds it does not belong to.  A group of at most
    ``small`` values is sorted once and every complement picks its middle from
    it; in a larger one a histogram counts each bucket by fold, and the rank of
    a complement is looked for in all folds' counts less those of ``h``.
    """
    bins = DEFAULT_BINS if bins is None else bins
    small = DEFAULT_SMALL if small is None else small
    vals = df.select(*keys, F.col(fold).cast("int").alias("_f"), F.col(value).cast("double").alias("_v"))
    vals = vals.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    by_fold = _fold_counts("_f", n_folds)
    sizes = vals.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_a"), F.max("_v").alias("_b"), by_fold.alias("_nf"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= small:
        return _sorted_complements(vals, keys, n_folds, out)
    big = _cut(sizes.where(F.col("_n") > F.lit(small)))
    n_big = big.count()
    names = big.select(*keys)
    rest = join_dim(vals, names, keys, "left_anti", known_rows=n_big)
    hot = join_dim(vals, names, keys, "left_semi", known_rows=n_big)
    return _sorted_complements(rest, keys, n_folds, out).unionByName(_refine_complements(hot, big, keys, n_folds, bins, small, out))


def _fold_counts(fold: str, n_folds: int) -> Column:
    return F.array(*[F.count_if(F.col(fold) == f) for f in range(n_folds)])


def _middle(lo: Column, hi: Column) -> Column:
    return F.when(lo == hi, lo).otherwise(0.5 * lo + 0.5 * hi)


def _sorted_complements(vals: DataFrame, keys: list[str], n_folds: int, out: str) -> DataFrame:
    """Groups of bounded size: one sorted array a group, filtered for each fold."""
    lists = vals.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_v", "_f"))).alias("_s"))
    rest = F.transform(F.sequence(F.lit(0), F.lit(n_folds - 1)), lambda h: F.struct(
        h.alias("h"), F.filter("_s", lambda x: x["_f"] != h).alias("s")))
    each = lists.select(*keys, F.explode(rest).alias("_e")).select(*keys, "_e.h", F.col("_e.s").alias("_s")).where(F.size("_s") > 0)
    n = F.size("_s")
    at = lambda i: F.get("_s", i.cast("int"))["_v"]
    return each.select(*keys, "h", _middle(at(F.floor((n - 1) / 2)), at(F.floor(n / 2))).alias(out))


def _refine_complements(vals: DataFrame, base: DataFrame, keys: list[str], n_folds: int, bins: int, small: int, out: str) -> DataFrame:
    """Histogram refinement, one histogram an interval for all complements whose
    rank lies in it.  An interval's ends are values of any fold."""
    folds = range(n_folds)
    wide = base.select(*keys, "_n", "_a", "_b", F.posexplode("_nf").alias("h", "_own"))
    left = F.col("_n") - F.col("_own")
    # the two middle ranks, counted from 0, among the values outside h
    targets = _cut(wide.where(left > 0).select(*keys, "h", "_a", "_b", F.floor((left - 1) / 2).alias("_lo"), F.floor(left / 2).alias("_hi")))
    cells = _cut(targets.select(*keys, "h", F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("__rank"), F.col("_a").alias("__a"),
                                F.col("_b").alias("__b")).select("*", F.lit(0).cast("long").alias("__off"), F.when(
                                    F.col("__a") == F.col("__b"), F.col("__a")).alias("__res"), F.lit(False).alias("__final")))
    while True:
        active = cells.where(F.col("__res").isNull() & ~F.col("__final"))
        intervals = _cut(active.select(*keys, "__a", "__b").distinct())
        n_int = intervals.count()
        if n_int == 0:
            break
        inside = join_dim(vals, intervals, keys, "inner", known_rows=n_int).where((F.col("_v") >= F.col("__a")) & (F.col("_v") <= F.col("__b")))
        hist = inside.groupBy(*keys, "__a", "__b", _bucket(F.col("_v"), F.col("__a"), F.col("__b"), bins).alias("_bk")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_bmin"), F.max("_v").alias("_bmax"), _fold_counts("_f", n_folds).alias("_cf"))
        w = Window.partitionBy(*keys, "__a", "__b").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
        before = lambda c: F.coalesce(F.sum(c).over(w), F.lit(0))
        hist = hist.withColumn("_below", before(F.col("_c"))).withColumn("_bf", F.array(*[before(F.col("_cf")[f]) for f in folds]))
        rank, below = F.col("__rank") - F.col("__off"), F.col("_below") - F.get("_bf", F.col("h"))
        found = active.join(hist, keys + ["__a", "__b"]).where((rank >= below) & (rank < below + F.col("_c") - F.get("_cf", F.col("h"))))
        step = found.select(
            *keys, "h", "__rank", F.col("_bmin").alias("__a"), F.col("_bmax").alias("__b"), (F.col("__off") + below).alias("__off"),
            F.when(F.col("_bmin") == F.col("_bmax"), F.col("_bmin")).alias("__res"),
            ((F.col("_bmin") != F.col("_bmax")) & (F.col("_c") <= F.lit(small))).alias("__final"))
        cells = _cut(cells.where(F.col("__res").isNotNull() | F.col("__final")).unionByName(step))

    fin = cells.where(F.col("__res").isNull() & F.col("__final"))
    fin_int = fin.select(*keys, "__a", "__b").distinct()
    n_fin = fin_int.count()
    resolved = cells.where(F.col("__res").isNotNull()).select(*keys, "h", "__rank", "__res")
    if n_fin:
        picked = (
            join_dim(vals, fin_int, keys, "inner", known_rows=n_fin)
            .where((F.col("_v") >= F.col("__a")) & (F.col("_v") <= F.col("__b")))
            .groupBy(*keys, "__a", "__b").agg(F.array_sort(F.collect_list(F.struct("_v", "_f"))).alias("_s"))
        )
        others = F.filter("_s", lambda x: x["_f"] != F.col("h"))
        resolved = resolved.unionByName(fin.join(picked, keys + ["__a", "__b"]).select(
            *keys, "h", "__rank", F.get(others, (F.col("__rank") - F.col("__off")).cast("int"))["_v"].alias("__res")))
    lo = resolved.select(*keys, "h", F.col("__rank").alias("_lo"), F.col("__res").alias("_vlo"))
    hi = resolved.select(*keys, "h", F.col("__rank").alias("_hi"), F.col("__res").alias("_vhi"))
    t = targets.join(lo, [*keys, "h", "_lo"]).join(hi, [*keys, "h", "_hi"])
    return t.select(*keys, "h", _middle(F.col("_vlo"), F.col("_vhi")).alias(out))


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], mode: str | None = None,
                     written_input: bool = False) -> dict[str, list | None]:
    """Exact quantiles of several columns of one frame, as driver-side
    numbers (one small row per column: the size is bounded by ``len(cols)``)."""
    if not cols:
        return {}
    if (mode or DEFAULT_MODE) == "aggregate":
        row = df.agg(*[F.percentile(F.col(f"`{c}`").cast("double"), probs).alias(c) for c in cols]).first()
        return {c: (list(row[c]) if row[c] is not None else None) for c in cols}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(f"`{c}`").cast("double").alias("_x")) for c in cols])).alias("_e")).select("_e._col", "_e._x")
    got = {r["_col"]: list(r["q"]) for r in exact_quantiles(long, "_x", probs, ["_col"], write_input=not written_input).collect()}
    return {c: got.get(c) for c in cols}


def column_medians(df: DataFrame, cols: list[str], mode: str | None = None, written_input: bool = False) -> dict[str, float | None]:
    """``written_input``: ``df`` is a scan of a written table, so refinement
    rounds re-read it (exploding the columns in-pipeline) instead of writing
    the long form."""
    return {c: (q[0] if q else None) for c, q in column_quantiles(df, cols, [0.5], mode, written_input).items()}
