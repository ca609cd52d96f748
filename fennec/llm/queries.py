"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import table
from . import (crf_language, fertility, line_chunks, lsh_forest, minhash_stars, nbest, pivot_kmeans, pseudonyms, sentence_spans, sql,
               template_html, token_store, whitening, winnowing)

QUERIES = {}
ORACLE = {}


def op2_decontamination(spark, sf_dir):
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        winnowing.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


QUERIES["op2_decontamination"] = op2_decontamination
ORACLE["op2_decontamination"] = sql.DECONTAMINATION


def op10_fertility(spark, sf_dir):
    return fertility.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "chars_per_token", "chars_per_token_2", "fallback_share", "token_entropy", "band_group")


QUERIES["op10_fertility"] = op10_fertility


def op8_main_text(spark, sf_dir):
    return template_html.extract(table(spark, sf_dir, "pages"))


QUERIES["op8_main_text"] = op8_main_text


def op1_token_store(spark, sf_dir):
    path = scratch_path(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), path)
    return token_store.read_store(spark, path)


QUERIES["op1_token_store"] = op1_token_store


def op9_line_chunks(spark, sf_dir):
    return line_chunks.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("__removed").alias("n_removed"), "text")


QUERIES["op9_line_chunks"] = op9_line_chunks


def op6_sentence_spans(spark, sf_dir):
    return sentence_spans.dedup_spans(table(spark, sf_dir, "documents"))


QUERIES["op6_sentence_spans"] = op6_sentence_spans

#: The key of the registered query; users pass their own.
PSEUDONYM_KEY = "key of the registered query"


def op5_pseudonyms(spark, sf_dir):
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


QUERIES["op5_pseudonyms"] = op5_pseudonyms


def op7_lsh_forest(spark, sf_dir):
    return lsh_forest.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


QUERIES["op7_lsh_forest"] = op7_lsh_forest


def op3_crf_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = crf_language.train(docs)
    found = crf_language.identify(docs, model)
    return found.select("doc_id", crf_language.held_out().alias("held_out"), "lang_pred", "score")


QUERIES["op3_crf_language"] = op3_crf_language


def op4_nbest(spark, sf_dir):
    return nbest.digests(table(spark, sf_dir, "documents"))


QUERIES["op4_nbest"] = op4_nbest


def op11_pivot_kmeans(spark, sf_dir):
    found, centroids = pivot_kmeans.kmeans(table(spark, sf_dir, "embeddings"))
    digests = [F.lit(x) for c, centroid in enumerate(centroids) for x in (c, pivot_kmeans.centroid_digest(centroid))]
    digest = F.create_map(*digests)[F.col("cluster")] if digests else F.lit(None).cast("string")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


QUERIES["op11_pivot_kmeans"] = op11_pivot_kmeans
ORACLE["op11_pivot_kmeans"] = sql.kmeans(pivot_kmeans.K, pivot_kmeans.ROUNDS, pivot_kmeans.DIMS, pivot_kmeans.SEED)


def op12_minhash_stars(spark, sf_dir):
    return minhash_stars.components(table(spark, sf_dir, "documents"))


QUERIES["op12_minhash_stars"] = op12_minhash_stars
ORACLE["op12_minhash_stars"] = sql.COMPONENTS


def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


QUERIES["op13_whitening"] = op13_whitening
