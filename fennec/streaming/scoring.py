"""Score a stream of product records with a fitted bundle (P8 on a stream).

Each micro-batch is scored with the batch plan inside ``foreachBatch``: the
fitted state tables are joined to it, the three members predict, and the result
is written to ``<sink>/batch_id=<n>`` with ``overwrite`` -- a replayed batch
rewrites the same folder, so the sink is idempotent and the checkpoint gives
exactly-once output.

The medians that fill what is missing are those of the stream, not of the
micro-batch: mergeable quantile sketches are the stream's state, one small table
a batch that holds the sketches of all rows so far (the one before it merged with
the batch's own; a replayed batch writes the same table again).  A run over what
is available first sketches all of it and then scores, so its results do not
depend on how files fall into micro-batches (beyond the sketches' rank error).  A
continuing stream fills a batch from all rows up to its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.assemble import align_columns, assemble, clean_median
from ..operators.sketches import K, column_sketches, merge_sketches, sketch_medians
from ..plans.features_b import ProductFeatureExtractor
from ..plans.jobs import generate_predictions, load_models
from ..sources.files import TEST_SCHEMA


def add_sketches(ex: ProductFeatureExtractor, batch: DataFrame, batch_id: int, state_dir: str, k: int = K) -> None:
    """Merge the sketches of ``batch`` into the state of the batch before it and write that."""
    spark = batch.sparkSession
    own = ex.median_inputs(batch)
    sketches = column_sketches(own, own.columns, k)
    if batch_id > 0:
        sketches = sketches.unionByName(spark.read.parquet(f"{state_dir}/batch_id={batch_id - 1}"))
    merge_sketches(sketches, k).coalesce(1).write.mode("overwrite").parquet(f"{state_dir}/batch_id={batch_id}")


def last_sketches(spark: SparkSession, state_dir: str) -> DataFrame:
    """The sketches of all rows so far, of the last batch written."""
    state = spark.read.parquet(state_dir)
    return state.where(F.col("batch_id") == F.lit(state.agg(F.max("batch_id")).first()[0])).drop("batch_id")


def score_stream(spark: SparkSession, model_dir: str, source_dir: str, sink_dir: str, checkpoint_dir: str,
                 source_format: str = "parquet", schema: str = TEST_SCHEMA, available_now: bool = True,
                 max_files_per_trigger: int | None = None, medians: str = "stream", sketch_k: int = K):
    """Start the scoring stream and return the ``StreamingQuery``.

    ``medians="batch"`` fills from each micro-batch's own exact medians."""
    models, ex, w = load_models(spark, model_dir)
    names = ex.get_feature_names()
    weights = tuple(w.values())
    state_dir = f"{checkpoint_dir}/median_sketches"

    def sketch_batch(batch: DataFrame, batch_id: int) -> None:
        add_sketches(ex, batch, batch_id, state_dir, sketch_k)

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        if medians == "batch":
            feats = ex.transform(batch)
            aligned = clean_median(align_columns(feats, names, keep=[ex.key]), names)
        else:
            if not available_now:
                sketch_batch(batch, batch_id)
            aligned = align_columns(ex.transform(batch, medians=sketch_medians(last_sketches(spark, state_dir))), names, keep=[ex.key])
        out = generate_predictions(assemble(aligned, names), models, weights, inverse_log=False, key=ex.key)
        out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")

    def start(run, checkpoint: str):
        reader = spark.readStream.schema(schema).format(source_format)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        writer = reader.load(source_dir).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
        return writer.start()

    if medians == "stream" and available_now:
        start(sketch_batch, f"{checkpoint_dir}/medians").awaitTermination()
    return start(score_batch, checkpoint_dir)
