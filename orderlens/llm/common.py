"""Shared helpers: written intermediate tables, size-checked broadcast, text maps, components.

Every intermediate table goes to the shared folder that ``spark.checkpoint.dir``
names, so a lost executor costs only the tasks that ran on it.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.session import shared_path

BATCH_ROWS = 1_000      # rows of an Arrow batch of texts
BATCH_BYTES = 1 << 20   # text bytes that one step of a task turns into Python objects
ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
         "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
         "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32()),
         "array<string>": pa.list_(pa.string())}


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    # one explicit schema: no footer job, and an empty table keeps its columns
    return spark.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only if it has at most ``max_rows`` rows.

    Larger tables are returned unmarked and Spark shuffles both sides.  Call it
    on written tables: the count then reads footers only.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def tidy(run: Callable) -> Callable:
    """``run`` with its memory given back to the system at the end: workers live on between tasks,
    and Arrow's pool and the C heap keep what a task has freed."""
    def outer(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return outer


def byte_slices(batch: pa.RecordBatch, at: int, limit: int = BATCH_BYTES):
    """Slices of ``batch`` whose texts in column ``at`` hold about ``limit`` bytes each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    room = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(room)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Fewer rows per Arrow batch, where the session has Spark's default of 10,000: with long texts
    those are tens of megabytes outside the heap, for each task and direction."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(rows))


def map_text(df: DataFrame, keep: list[str], text: str, start: Callable, out: list[tuple]) -> DataFrame:
    """Arrow-batch map over one text column.

    ``start()`` runs once per task and returns ``f(texts) -> list of columns``
    in the order of ``out`` (name, type); nulls arrive as ``None``.  Columns in
    ``keep`` pass through unchanged (64-bit ids keep their exact type).  Texts
    come in slices of about ``BATCH_BYTES``, so a task never holds the Python
    objects of a whole Arrow batch.
    """
    small_batches(df.sparkSession)
    df = df.select(*keep, F.col(text).alias("_text_in"))
    schema = T.StructType([df.schema[c] for c in keep]
                          + [T.StructField(n, T._parse_datatype_string(t)) for n, t in out])
    names = [f.name for f in schema.fields]
    types = [ARROW[t] for _, t in out]
    n_keep = len(keep)

    def run(batches):
        f = start()
        for b in (part for whole in batches for part in byte_slices(whole, n_keep)):
            cols = f(b.column(n_keep).to_pylist())
            arrays = [b.column(i) for i in range(n_keep)]
            arrays += [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return df.mapInArrow(tidy(run), schema)


def connected_components(edges: DataFrame, tag: str) -> DataFrame:
    """(node, component): component = smallest node reachable over ``edges`` (a, b).

    Contraction: in each round every node takes the neighbour (or itself) with
    the smallest hash, edges are renamed to those labels and loops are dropped;
    the hash changes with the round, so a constant share of nodes vanishes on
    any graph.  The labels are written before each join, so a hub node meets a
    plain skew join that adaptive execution splits.
    """
    spark = edges.sparkSession
    both = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    live = written(both.where("a <> b").distinct(), f"{tag}-edges0")
    maps = []
    while not live.isEmpty():
        seed = F.lit(len(maps))
        sym = live.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            live.select(F.col("b").alias("u"), F.col("a").alias("v")))
        best = sym.groupBy("u").agg(F.min(F.struct(F.xxhash64("v", seed).alias("h"), "v")).alias("m"))
        own = F.struct(F.xxhash64("u", seed).alias("h"), F.col("u").alias("v"))
        label = written(best.select("u", F.least(F.col("m"), own).getField("v").alias("l")),
                        f"{tag}-label{len(maps)}")
        maps.append(label)
        la = label.select(F.col("u").alias("a"), F.col("l").alias("x"))
        lb = label.select(F.col("u").alias("b"), F.col("l").alias("y"))
        step = live.join(la, "a").join(lb, "b").where("x <> y")
        live = written(step.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                       .distinct(), f"{tag}-edges{len(maps)}")
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    found = maps[0].select(F.col("u").alias("node"), F.col("l").alias("top"))
    for label in maps[1:]:
        up = label.select(F.col("u").alias("top"), F.col("l").alias("up"))
        found = found.join(up, "top", "left").select("node", F.coalesce("up", "top").alias("top"))
    found = written(found, f"{tag}-top")
    least = written(found.groupBy("top").agg(F.min("node").alias("component")), f"{tag}-least")
    return found.join(least, "top").select("node", "component")
