"""TF-IDF over word n-grams (V1-V12), fitted and applied as Spark jobs.

Fit:   docs -> terms (lower, optional accent fold, tokens, stop words, n-grams)
       -> explode -> (doc, term) counts -> per-term document frequency and
       total count -> df bounds -> top-k by total count (ties: term) ->
       alphabetical index, smooth idf ``ln((1+n)/(1+df)) + 1``.
Apply: same terms, semi-joined to the vocabulary *before* counting, tf weight
       (``1 + ln(tf)`` when sublinear), times idf, L2-normalised per document.

The vocabulary is bounded by ``max_features`` (a ``limit``), which is what
makes broadcasting it safe; without ``max_features`` it is joined normally.
Output is long form ``(id, idx, term, weight)`` -- the sparse matrix -- or a
dense array/vector of ``len(vocab)`` weights per row for model assembly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..sources.files import materialize
from .label_encoder import dense_index
from ..functions.text import drop_stop_words, english_stop_words, explode_terms, fold_text_frame, marked_ngrams, marked_tokens, ngram_range, word_tokens


@dataclass
class TfidfVectorizer:
    max_features: int | None = 150
    ngram_range: tuple[int, int] = (1, 3)
    min_df: int | float = 3
    max_df: int | float = 0.85
    strip_accents: bool = True
    stop_words: str | tuple[str, ...] | None = "english"
    sublinear_tf: bool = True
    lowercase: bool = True

    def _stop(self) -> tuple[str, ...]:
        if self.stop_words is None:
            return ()
        if self.stop_words == "english":
            return english_stop_words()
        return tuple(self.stop_words)

    def tokens(self, text: Column) -> Column:
        toks = word_tokens(text, self.lowercase, self.strip_accents)
        stop = self._stop()
        return drop_stop_words(toks, stop) if stop else toks

    def _tokenized(self, df: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
        """``keep + [_toks]``; with accent folding, the folded text is projected
        in stages so its translate pass runs once per document."""
        if isinstance(df.schema[text_col].dataType, ArrayType):  # tokens already (written_tokens)
            return df.select(*keep, F.coalesce(F.col(text_col), F.array().cast("array<string>")).alias("_toks"))
        if not self.strip_accents:
            return df.select(*keep, self.tokens(F.col(text_col)).alias("_toks"))
        folded = fold_text_frame(df, F.col(text_col), keep, "_t", self.lowercase)
        toks = word_tokens(F.col("_t"), lowercase=False, strip_accents=False)
        stop = self._stop()
        return folded.select(*[f"`{c}`" for c in folded.columns if c != "_t"], (drop_stop_words(toks, stop) if stop else toks).alias("_toks"))

    def token_frame(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(_id, _toks)``."""
        return self._tokenized(df, text_col, [F.col(id_col).alias("_id")])

    def written_tokens(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(id_col, text_col)`` with the tokens in place of each text, written
        once.  ``fit`` and the transforms take such a column for the text itself,
        so that texts which go through both are folded and tokenized once."""
        toks = self._tokenized(df, text_col, [F.col(id_col)])
        return materialize(toks.withColumnRenamed("_toks", text_col), "tokens")

    def _bound(self, v: int | float, n: Column) -> Column:
        return F.lit(v).cast("double") if isinstance(v, int) else F.lit(float(v)) * n

    def grams(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(_id, _grams)``: the n-gram array of every document.

        Tokens are projected first and the n-grams built over that column, so
        the tokenizer runs once per document (a lambda over an expression would
        re-run it for every n-gram position).
        """
        toks = self.token_frame(df, id_col, text_col)
        return toks.select("_id", ngram_range(F.col("_toks"), *self.ngram_range).alias("_grams"))

    @staticmethod
    def _term_stats(arrays: DataFrame, col: str, counted: str | None = None) -> DataFrame:
        """``(term, df, total_tf)`` in ONE term-keyed aggregation: every
        occurrence (tag 0) and every distinct term of a document (tag 1,
        ``array_distinct`` inside the row) come from one explode and are counted.  Map-side
        partial aggregation collapses repeats before the shuffle, so the
        shuffle carries distinct terms per task, never (document, term) pairs.
        ``counted`` names an array of other terms whose occurrences the caller has
        counted already: only their documents are."""
        def tagged(terms, tag: int) -> Column:
            return F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(tag).alias("_tag")))

        parts = [tagged(col, 0), tagged(F.array_distinct(col), 1)] + ([tagged(F.array_distinct(counted), 1)] if counted else [])
        rows = arrays.select(explode_terms(F.concat(*parts)).alias("_e")).select("_e.term", "_e._tag").where(F.col("term").isNotNull())
        return rows.groupBy("term").agg(F.count_if(F.col("_tag") == 1).alias("df"), F.count_if(F.col("_tag") == 0).alias("total_tf"))

    def _eligible(self, stats: DataFrame, n_docs) -> DataFrame:
        s = stats.withColumn("_n", n_docs)
        return s.where((F.col("df") >= self._bound(self.min_df, F.col("_n"))) & (F.col("df") <= self._bound(self.max_df, F.col("_n"))))

    def _prunes(self) -> bool:
        lo, hi = self.ngram_range
        return self.max_features is not None and lo == 1 and hi > 1

    def _marked(self, marked: Column, lo: int) -> Column:
        parts = [marked_ngrams(marked, n) for n in range(lo, self.ngram_range[1] + 1)]
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    def _pruned_stats(self, toks: DataFrame, n_docs) -> DataFrame | None:
        """Exact pruning for a top-k vocabulary that includes unigrams.

        The tokens that occur at least L times are the frequent ones.  An n-gram
        occurs at most as often as each of its tokens, so the statistics of the
        terms made of frequent tokens hold every term counted L times or more.
        If k of those are eligible, the top k are among them; otherwise L is
        lowered.  Of all other tokens only the total is counted.  Returns None
        (count everything) when pruning does not apply or more tokens would be
        frequent than can be tested inside rows."""
        if not self._prunes():
            return None
        k = self.max_features
        words = toks.select(explode_terms(F.col("_toks")).alias("term")).where(F.col("term").isNotNull())
        totals = _cut_small(words.groupBy("term").agg(F.count(F.lit(1)).alias("total_tf")))
        n = min(k + max(16, k // 4), FREQUENT_TOKEN_LIMIT)
        while True:
            # at most FREQUENT_TOKEN_LIMIT + 1 rows reach the driver
            top = totals.orderBy(F.desc("total_tf"), F.asc("term")).limit(n + 1).collect()
            # the first token left out bounds L from below: its count may be shared with others
            least = top[n]["total_tf"] + 1 if len(top) > n else 1
            frequent = [r for r in top if r["total_tf"] >= least]
            if frequent:
                keep = [r["term"] for r in frequent]
                marked = toks.select(marked_tokens(F.col("_toks"), keep).alias("_m"))
                grams = marked.select(marked_ngrams(F.col("_m"), 1).alias("_words"), self._marked(F.col("_m"), 2).alias("_grams"))
                known = toks.sparkSession.createDataFrame([(r["term"], r["total_tf"]) for r in frequent], "term string, _total long")
                stats = self._term_stats(grams, "_grams", "_words").join(F.broadcast(known), "term", "left")
                stats = _cut_small(stats.select("term", "df", F.coalesce("_total", "total_tf").alias("total_tf")))
                if least == 1 or self._eligible(stats, n_docs).where(F.col("total_tf") >= least).limit(k).count() == k:
                    return stats
            elif len(top) <= n:
                return None  # no tokens at all
            if n >= FREQUENT_TOKEN_LIMIT:
                return None
            n = min(8 * n, FREQUENT_TOKEN_LIMIT)

    def fit(self, df: DataFrame, id_col: str, text_col: str) -> "TfidfModel":
        """Term statistics, df bounds, top-k, alphabetical index, idf."""
        n_docs = df.agg(F.count(F.lit(1)).cast("double")).scalar()
        toks = self.token_frame(df, id_col, text_col)
        if self._prunes() and not isinstance(df.schema[text_col].dataType, ArrayType):
            toks = materialize(toks, "tokens")  # read for the tokens and for the n-grams: tokenized once
        stats = self._pruned_stats(toks, n_docs)
        if stats is None:
            stats = self._term_stats(toks.select(ngram_range(F.col("_toks"), *self.ngram_range).alias("_grams")), "_grams")
        kept = self._eligible(stats, n_docs)
        if self.max_features is not None:
            kept = kept.orderBy(F.desc("total_tf"), F.asc("term")).limit(self.max_features)
        idf = F.log((F.lit(1.0) + F.col("_n")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
        if self.max_features is None:
            # as many rows as terms: positions by range-sorted partitions, not in one task
            kept = _cut_small(kept)
            kept = kept.join(dense_index(kept, "term", "idx"), "term")
        else:
            # alphabetical column order; the window runs over at most max_features rows
            kept = kept.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
        vocab = kept.select("term", "idx", "df", "total_tf", idf.alias("idf"))
        return TfidfModel(self, vocab, bounded=self.max_features is not None).materialize()


# Above this many frequent tokens the pruning set is not tested inside rows
# and every n-gram is counted instead (same result, more work).
FREQUENT_TOKEN_LIMIT = 50_000


def _cut_small(df: DataFrame) -> DataFrame:
    """Statistics that are read several times: written once (reliable
    checkpoint into the shared checkpoint folder)."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@dataclass
class TfidfModel:
    params: TfidfVectorizer
    vocab: DataFrame  # term, idx, df, total_tf, idf
    bounded: bool = True

    def materialize(self) -> "TfidfModel":
        """Run the fit once.  A bounded vocabulary (at most ``max_features``
        rows) is held on the driver like MLlib's CountVectorizerModel; an
        unbounded one is checkpointed to the shared checkpoint folder."""
        if self.bounded:
            rows = self.vocab.collect()
            spark = self.vocab.sparkSession
            self.vocab = spark.createDataFrame(rows, self.vocab.schema)
            self._rows = rows
            self._size = len(rows)
        else:
            self.vocab = _cut_small(self.vocab)
            self._size = None
        return self

    def _vocab(self, *cols: str) -> DataFrame:
        v = self.vocab.select(*cols)
        return F.broadcast(v) if self.bounded else v

    def _row_weights(self, df: DataFrame, text_col: str, keep: list[str], out: str) -> DataFrame:
        """Bounded vocabulary: ``keep + [out]`` with ``out`` the L2-normalised
        weights of the row, computed inside the row -- no shuffle.

        N-grams are built over the vocabulary's tokens alone and filtered against
        the vocabulary (hash-set membership), MLlib's
        ``CountVectorizerModel`` counts the hits per row in the JVM, and tf
        weighting, idf and the L2 norm are array expressions."""
        p = self.params
        rows = sorted(self._rows, key=lambda r: r["idx"])
        terms = [r["term"] for r in rows]
        k = len(terms)
        cols = [F.col(f"`{c}`") for c in keep]
        if k == 0:
            return df.select(*cols, F.array().cast("array<double>").alias(out))
        # a vocabulary n-gram is made only of tokens that occur in vocabulary terms
        parts = sorted({t for term in terms for t in term.split(" ")})
        base = p._tokenized(df, text_col, cols)
        base = base.select(*cols, marked_tokens(F.col("_toks"), parts).alias("_m"))
        base = base.select(*cols, p._marked(F.col("_m"), p.ngram_range[0]).alias("_g"))
        base = base.select(*cols, F.filter("_g", lambda x: x.isin(terms)).alias("_hits"))
        counted = CountVectorizerModel.from_vocabulary(terms, inputCol="_hits", outputCol="_cv").transform(base)
        idf = F.array(*[F.lit(float(r["idf"])) for r in rows])
        if p.sublinear_tf:
            weight = lambda c, i: F.when(c > 0, (F.lit(1.0) + F.log(c)) * i).otherwise(F.lit(0.0))
        else:
            weight = lambda c, i: c * i
        w = counted.select(*cols, F.zip_with(vector_to_array(F.col("_cv")), idf, weight).alias("_w"))
        w = w.select(*cols, "_w", F.sqrt(F.aggregate("_w", F.lit(0.0), lambda acc, x: acc + x * x)).alias("_norm"))
        return w.select(*cols, F.when(F.col("_norm") > 0, F.transform("_w", lambda x: x / F.col("_norm")))
                        .otherwise(F.col("_w")).alias(out))

    def transform_long(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(id, idx, term, weight)`` for the non-zero entries; V8-V11.

        Bounded vocabulary: the row's weights are computed inside the row
        (``_row_weights``) and the non-zero positions exploded -- map-only.
        Unbounded: vocabulary hits are exploded, counted per (document, term)
        and normalised per document."""
        p = self.params
        if self.bounded:
            terms = F.array(*[F.lit(r["term"]) for r in sorted(self._rows, key=lambda r: r["idx"])])
            w = self._row_weights(df, text_col, [id_col], "_w")
            pos = w.select(F.col(id_col), F.posexplode_outer("_w").alias("idx", "weight")).where(F.col("weight") > 0)
            return pos.select(id_col, "idx", F.element_at(terms, F.col("idx") + 1).alias("term"), "weight")
        g = p.grams(df, id_col, text_col)
        hits = g.select("_id", explode_terms(F.col("_grams")).alias("term")).join(self._vocab("term"), "term", "left_semi")
        hits = hits.where(F.col("term").isNotNull())
        tf = hits.groupBy("_id", "term").agg(F.count(F.lit(1)).alias("tf"))
        w_tf = (F.lit(1.0) + F.log(F.col("tf").cast("double"))) if p.sublinear_tf else F.col("tf").cast("double")
        w = tf.join(self._vocab("term", "idx", "idf"), "term").select("_id", "idx", "term", (w_tf * F.col("idf")).alias("w"))
        norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("_id")))
        return w.select(F.col("_id").alias(id_col), "idx", "term", (F.col("w") / norm).alias("weight"))

    def size(self) -> int:
        n = getattr(self, "_size", None)
        return self.vocab.count() if n is None else n

    def transform_dense(self, df: DataFrame, id_col: str, text_col: str, out: str = "tfidf", size: int | None = None) -> DataFrame:
        """Adds ``out`` = array<double> of ``size`` weights (0 for absent terms) per row."""
        k = self.size() if size is None else size
        if self.bounded:
            res = self._row_weights(df, text_col, df.columns, out)
            if k == self.size():
                return res
            pad = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.get(F.col(out), i), F.lit(0.0)))
            return res.withColumn(out, pad if k > 0 else F.array().cast("array<double>"))
        long = self.transform_long(df, id_col, text_col)
        per_doc = long.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("idx", "weight"))).alias("_m"))
        dense = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.element_at(F.col("_m"), i), F.lit(0.0)))
        dense = dense if k > 0 else F.array().cast("array<double>")
        return df.join(per_doc, id_col, "left").withColumn(out, dense).drop("_m")

    def transform_columns(self, df: DataFrame, id_col: str, text_col: str, prefix: str = "text_", size: int | None = None) -> tuple[DataFrame, list[str]]:
        """Named dense columns ``prefix{i}`` in vocabulary (alphabetical) order."""
        k = self.size() if size is None else size
        out = self.transform_dense(df, id_col, text_col, "_tfidf", k)
        names = [f"{prefix}{i}" for i in range(k)]
        return out.withColumns({n: F.col("_tfidf")[i] for i, n in enumerate(names)}).drop("_tfidf"), names
