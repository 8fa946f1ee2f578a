"""Structured Streaming: the reference's timed delta (120 s) and main (86,400 s) rebuilds, re-aimed.

* ``stream_delta_index``: new or changed documents become postings in small steps
  (``foreachBatch``; every batch goes to its own ``batch=<id>`` folder with overwrite, so a replayed
  batch rewrites the same files: exactly-once output on top of at-least-once execution).
* ``compact``: merge delta into main as a batch job (anti join + union, written to a new folder).
* ``stream_dedup``: the latest version of each key, with a 36-hour look-back (watermark).
* ``stream_facets``: counts per time bucket as data arrives (tumbling / sliding / session windows).
* ``stream_alerts``: standing queries (a stored queries table) matched against each new batch.

Checkpoints live under the shared ``spark.checkpoint.dir`` so a restarted driver or lost executor
resumes from the last committed batch.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import index as ix
from quarry.operators import match as mt
from quarry.session import scratch_path

# ---- fixed values: refresh intervals and look-back of the reference ----
DELTA_TRIGGER = "120 seconds"
LOOKBACK = "36 hours"


def read_stream(spark: SparkSession, directory: str, schema: T.StructType, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(directory)


def read_table_stream(spark: SparkSession, directory: str, name: str, schema: T.StructType) -> DataFrame:
    """A stored table (``<name>.parquet`` in ``directory``, one file or a folder of files) as a stream. The name is a glob, as
    a stream's plain path must be a folder, and a file filter on the name would leave out a folder's files."""
    return read_stream(spark, f"{directory.rstrip('/')}/{name}.parque[t]", schema)


def _run(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool,
         trigger: str = DELTA_TRIGGER, output_mode: str = "append"):
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).outputMode(output_mode)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def stream_delta_index(stream: DataFrame, fields, out_dir: str, checkpoint: str, id_col: str = "doc_id",
                       prepare: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = False):
    """Tokenize every micro-batch and append its postings under ``out_dir/postings/batch=<id>``
    (documents under ``out_dir/docs/batch=<id>``). Returns the running query."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        d = prepare(batch) if prepare else batch
        idx = ix.build_index("delta", d, fields, id_col)
        path = f"{out_dir}/postings/batch={batch_id}"
        idx.postings.select("term", "doc_id", "field", "pos").write.mode("overwrite").parquet(path)
        idx.docs.write.mode("overwrite").parquet(f"{out_dir}/docs/batch={batch_id}")
        lengths = ix.postings_lengths(d.sparkSession.read.parquet(path))  # from what was written, not tokenized again
        lengths.write.mode("overwrite").parquet(f"{out_dir}/lengths/batch={batch_id}")

    return _run(stream, per_batch, checkpoint, available_now)


def read_stream_index(spark: SparkSession, out_dir: str, fields) -> ix.Index:
    """The postings written so far as one index. A document seen in several batches keeps only its
    latest batch (changed documents replace older versions)."""
    docs = spark.read.parquet(f"{out_dir}/docs")
    latest = docs.groupBy("doc_id").agg(F.max("batch").alias("batch"))

    def keep(df):
        return df.join(latest, ["doc_id", "batch"], "left_semi").drop("batch")

    return ix.Index("delta", keep(docs), keep(spark.read.parquet(f"{out_dir}/postings")),
                    keep(spark.read.parquet(f"{out_dir}/lengths")), tuple(fields))


def compact(main: ix.Index, delta: ix.Index, out_dir: str) -> ix.Index:
    """Merge delta into main (delta wins per document) and write the result to a new folder; the
    caller repoints readers to it (the reference's index rotation)."""
    from quarry.sources.index_io import read_index, write_index

    merged = mt.main_delta(main, delta).settled()
    write_index(merged, out_dir)
    return read_index(main.postings.sparkSession, out_dir)


def stream_dedup(stream: DataFrame, keys: list[str], ts_col: str, delay: str = LOOKBACK) -> DataFrame:
    """The latest version of every key as it arrives (update mode): the newest row by ``ts_col``, then by
    the other columns. Versions older than the watermark are dropped. State holds one row per key and
    look-back window and is freed once the watermark has passed the window; ``latest_versions``
    picks a key's newest row from what was written.

    ``timestamp_ntz`` columns are cast to ``timestamp`` first (watermarks need it)."""
    s = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)
    rest = [c for c in s.columns if c != ts_col and c not in keys]
    return (s.groupBy(F.window(ts_col, delay).alias("_w"), *keys)
            .agg(F.max(F.struct(ts_col, *rest)).alias("_row")).select(*keys, "_row.*"))


def run_versions(df: DataFrame, out_dir: str, checkpoint: str, available_now: bool = False):
    """Write every batch of ``stream_dedup`` to its own folder. Returns the running query."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    return _run(df, per_batch, checkpoint, available_now, output_mode="update")


def latest_versions(written: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """One row per key: the newest of its written versions."""
    rest = [c for c in written.columns if c not in (ts_col, "batch", *keys)]
    return written.groupBy(*keys).agg(F.max(F.struct(ts_col, *rest)).alias("_row")).select(*keys, "_row.*")


def stream_facets(stream: DataFrame, ts_col: str, keys: list[str], window: str = "1 day",
                  slide: str | None = None, session_gap: str | None = None, delay: str = LOOKBACK) -> DataFrame:
    """Match counts per time bucket and key: tumbling (``window``), sliding (``slide``) or session
    (``session_gap``) windows, with a watermark for late rows."""
    s = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)
    if session_gap:
        w = F.session_window(ts_col, session_gap)
    elif slide:
        w = F.window(ts_col, window, slide)
    else:
        w = F.window(ts_col, window)
    return (s.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("count"))
            .select(F.unix_timestamp(F.col("w.start")).alias("window_start"),
                    F.unix_timestamp(F.col("w.end")).alias("window_end"), *keys, "count"))


def stream_alerts(stream: DataFrame, queries: DataFrame, fields, out_dir: str, checkpoint: str,
                  id_col: str = "doc_id", prepare: Callable[[DataFrame], DataFrame] | None = None,
                  available_now: bool = False):
    """Standing queries: every new batch of documents is indexed and matched (all words) against
    the stored queries table; matches go to ``out_dir/batch=<id>`` (``match_standing``: no pair of query and document is
    exchanged)."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        d = prepare(batch) if prepare else batch
        idx = ix.build_index("alerts", d, fields, id_col)
        m = mt.match_standing(idx.lists_for(queries), queries, idx).withColumn("batch_id", F.lit(batch_id).cast("long"))
        m.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    return _run(stream, per_batch, checkpoint, available_now)


def run_to_sink(df: DataFrame, name: str, checkpoint: str | None = None, mode: str = "complete",
                available_now: bool = True) -> str:
    """Run an aggregating stream to completion into a Parquet folder (replaced by each batch in
    complete mode); returns the folder."""
    spark = df.sparkSession
    out = scratch_path(spark, name)
    ckpt = checkpoint or scratch_path(spark, f"{name}-ckpt")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(out)  # each batch holds the whole result
        else:
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = _run(df, per_batch, ckpt, available_now, output_mode=mode)
    q.awaitTermination()
    return out
