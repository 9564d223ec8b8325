"""Parquet folder reading, per-file de-duplication, load reports and writers.

S1-S10 of the operator inventory.  Everything is lazy DataFrame work; the
schema comparison reads the first file's footer first.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.footers import file_schema, list_files, schema_differences

# Fixed values ------------------------------------------------------------
PARQUET_GLOB = "*.parquet"
SOURCE_FILE_COL = "_source_file"


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, (str, os.PathLike)) else [str(p) for p in paths]


def read_parquet_folder(spark: SparkSession, paths: str | Sequence[str], *,
                        per_file_dedup: bool = True, glob: str = PARQUET_GLOB,
                        merge_schema: bool = False, keep_source: bool = False) -> DataFrame:
    """Read every ``glob`` file directly in ``paths`` (not recursive) and stack them.

    ``per_file_dedup`` drops exact duplicate rows *within* each file only:
    copies of a row in two different files both survive (S2).  The source
    file comes from the hidden ``_metadata.file_path`` column, so no driver
    loop over files is needed.
    Raises FileNotFoundError when nothing matches.
    """
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "false")
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    try:
        df = reader.parquet(*_as_list(paths))
    except AnalysisException as exc:  # missing folder, or no file matched
        msg = str(exc)
        if "PATH_NOT_FOUND" in msg or "UNABLE_TO_INFER_SCHEMA" in msg or "infer schema" in msg:
            raise FileNotFoundError(f"no parquet files in {paths!r}") from exc
        raise
    if not (per_file_dedup or keep_source):
        return df
    data_cols = df.columns
    with_src = df.withColumn(SOURCE_FILE_COL, F.col("_metadata.file_path"))
    if per_file_dedup:
        with_src = with_src.dropDuplicates()
    return with_src if keep_source else with_src.select(*data_cols)


def stack_frames(frames: Iterable[DataFrame], *, per_frame_dedup: bool = True) -> DataFrame:
    """UNION ALL by column name; missing columns become null."""
    out = None
    for df in frames:
        part = df.dropDuplicates() if per_frame_dedup else df
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no frames to stack")
    return out


def file_row_report(df_with_source: DataFrame) -> DataFrame:
    """Rows per source file after de-duplication plus a total row.

    Input must carry ``_source_file`` (``read_parquet_folder(keep_source=True)``).
    The total row has ``file_name = '__total__'``; a conservation check is
    ``sum(per file) == total``.
    """
    name = F.regexp_extract(F.col(SOURCE_FILE_COL), r"([^/]+)$", 1)
    per_file = (df_with_source.groupBy(name.alias("file_name"))
                .agg(F.count(F.lit(1)).alias("n_rows")))
    total = df_with_source.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("__total__").alias("file_name"), "n_rows")
    return per_file.unionByName(total)


def load_report(df: DataFrame, key: str) -> DataFrame:
    """Unique keys, rows and rows per key, one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.col(key)).alias("n_keys"),
    ).withColumn("rows_per_key", F.round(F.col("n_rows") / F.col("n_keys"), 4))


def schema_report(spark: SparkSession, folder: str, glob: str = PARQUET_GLOB) -> DataFrame:
    """Compare every file's schema with the first file's.

    The files are listed as rows and tasks read their footers, so the number of
    jobs does not grow with the number of files.  Result columns: file_name,
    column, ref_type, file_type, status in {same, missing, extra, retyped,
    unreadable}.
    """
    files = list_files(spark, folder, glob)
    first = files.agg(F.min("path")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no parquet files in {folder!r}")
    reference = file_schema(files.filter(F.col("path") == first))
    name = F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name")
    return schema_differences(files, reference).select(name, "column", "ref_type", "file_type", "status")


def write_processed(df: DataFrame, path: str, *, fail_if_empty: bool = True,
                    mode: str = "overwrite", partition_by: Sequence[str] | None = None) -> str:
    """Write a parquet result; reject an empty frame when asked.

    No ``coalesce(1)``: every task writes its own part file.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # looked at after the write: the result is computed once, this reads a footer
    if fail_if_empty and df.sparkSession.read.schema(df.schema).parquet(path).isEmpty():
        raise ValueError("the result written is an empty DataFrame")
    return path


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Read a processed parquet result."""
    return spark.read.parquet(path)


def write_json_lines(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """JSON lines, one object per row."""
    df.write.mode(mode).json(path)
    return path


def read_json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read JSON lines back with their schema (S9, S10); a line that does not fit it is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
