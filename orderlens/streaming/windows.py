"""Structured Streaming forms.

R1 scores a stream of record files with a saved model: stateless, so no
watermark; invalid records and unfit files go to their own sinks.
R2 counts events per (time window, type).  ``mode='append'`` uses a
watermark and emits each window once it is final (bounded state, the form
for endless streams); ``mode='complete'`` re-emits the full table each
micro-batch through ``foreachBatch`` and is meant for bounded replays where
every window must appear at the end.

Checkpoints and outputs live under the session's shared checkpoint folder
(``spark.checkpoint.dir``) unless a path is given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.scalar import utc_as_wall_clock, wall_clock_as_utc
from orderlens.session import shared_path
from orderlens.sources.footers import file_schema, list_files, schema_differences


def windowed_counts(df: DataFrame, ts_col: str, key_col: str, window: str = "1 day",
                    watermark: str | None = None) -> DataFrame:
    """Rows per (tumbling window, key); works on batch and streaming frames.

    Watermarks need TIMESTAMP event times: a TIMESTAMP_NTZ column is read as
    UTC wall clock (whatever the session time zone) and the window bounds
    are turned back into wall clock, so the output keeps the input's type
    and windows start at wall-clock midnight.
    """
    ntz = dict(df.dtypes)[ts_col] == "timestamp_ntz"
    src = df.withColumn(ts_col, wall_clock_as_utc(ts_col)) if ntz else df
    if watermark:
        src = src.withWatermark(ts_col, watermark)
    agg = src.groupBy(F.window(ts_col, window).alias("w"), F.col(key_col)).agg(
        F.count(F.lit(1)).alias("n"))
    start, end = F.col("w.start"), F.col("w.end")
    if ntz:
        start, end = utc_as_wall_clock(start), utc_as_wall_clock(end)
    return agg.select(start.alias("window_start"), end.alias("window_end"), key_col, "n")


def _file_stream(spark: SparkSession, source_dir: str, glob: str,
                 max_files_per_trigger: int | None = None, schema=None) -> DataFrame:
    """Parquet file stream over ``source_dir`` restricted to files matching ``glob``."""
    if schema is None:
        schema = spark.read.option("pathGlobFilter", glob).parquet(source_dir).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def stream_windowed_counts(spark: SparkSession, source_dir: str, ts_col: str, key_col: str, *,
                           glob: str = "*.parquet", window: str = "1 day",
                           watermark: str = "1 hour", mode: str = "complete",
                           out_path: str | None = None,
                           max_files_per_trigger: int | None = None) -> str:
    """Run R2 over the parquet files in ``source_dir`` until they are consumed
    (``availableNow``) and return the output path.

    The checkpoint lies beside the output: a later call with the same
    ``out_path`` goes on with new files and the kept state.  In append mode rows
    of windows that the watermark has passed are dropped, and each window is
    written once, when the watermark passes its end.
    """
    events = _file_stream(spark, source_dir, glob, max_files_per_trigger)
    counts = windowed_counts(events, ts_col, key_col, window, watermark)
    out = out_path or shared_path(spark, f"r2-counts-{uuid.uuid4().hex[:12]}")
    ckpt = out.rstrip("/") + "-checkpoint"
    if mode == "append":
        q = (counts.writeStream.outputMode("append").format("parquet")
             .option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
    else:
        def write_batch(batch: DataFrame, _epoch: int) -> None:
            batch.write.mode("overwrite").parquet(out)

        q = (counts.writeStream.outputMode("complete").foreachBatch(write_batch)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return out


def stream_scores(spark: SparkSession, source_dir: str, score_fn, *, glob: str = "*.parquet",
                  schema: str | None = None, out_path: str | None = None,
                  quarantine_path: str | None = None,
                  max_files_per_trigger: int | None = None) -> tuple[str, str]:
    """Score every record file that arrives in ``source_dir``.

    ``score_fn(batch_df) -> (scored_df, quarantined_df)`` (e.g. a partial of
    :func:`orderlens.plans.scoring.predict_batch`).  The stream is one of
    files: tasks read their footers first, and a file that cannot be read or
    whose columns differ from ``schema`` (default: the first file's) goes to the
    ``-files`` folder beside the quarantine with the reason; the others are
    scored.  Each micro-batch is written to its own ``batch=<id>`` folder of all
    outputs with overwrite, so a replayed batch replaces its first try and every
    record is there once.  The checkpoint belongs to the output path: a second
    call with the same ``out_path`` goes on where the first ended.  Stateless,
    so no watermark.
    """
    wanted = ({f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(schema).fields} if schema
              else file_schema(list_files(spark, source_dir, glob)))
    if not wanted:
        raise FileNotFoundError(f"no readable parquet file in {source_dir!r}")
    ddl = T.StructType([T.StructField(c, T._parse_datatype_string(t)) for c, t in wanted.items()])
    reader = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, "
                                                           "content binary").option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(source_dir).select("path", "length")
    out = out_path or shared_path(spark, f"r1-scores-{uuid.uuid4().hex[:12]}")
    bad = quarantine_path or out.rstrip("/") + "-quarantine"

    def write_batch(batch: DataFrame, epoch: int) -> None:
        checked = schema_differences(batch, wanted).persist()
        try:
            reason = F.when(F.col("status") == "unreadable", F.concat(F.lit("unreadable: "), "error")).when(
                F.col("status") != "same", F.concat("column", F.lit(": "), "status"))
            per_file = checked.groupBy("path").agg(
                F.array_sort(F.collect_list(reason)).alias("reasons")).persist()
            (per_file.filter(F.size("reasons") > 0).write.mode("overwrite")
             .parquet(f"{bad.rstrip('/')}-files/batch={epoch}"))
            good = [r["path"] for r in per_file.filter(F.size("reasons") == 0).collect()]   # one batch's files
            per_file.unpersist()
        finally:
            checked.unpersist()
        records = (spark.read.schema(ddl).parquet(*good) if good else spark.createDataFrame([], ddl)).persist()
        try:                                            # two writes read one micro-batch
            scored, quarantined = score_fn(records)
            scored.write.mode("overwrite").parquet(f"{out}/batch={epoch}")
            quarantined.write.mode("overwrite").parquet(f"{bad}/batch={epoch}")
        finally:
            records.unpersist()

    q = (files.writeStream.foreachBatch(write_batch).option("checkpointLocation", out.rstrip("/") + "-checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return out, bad
