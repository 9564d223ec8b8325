"""Parquet footers read by tasks: schemas of any number of files in one job.

Files are listed as rows and each task reads the footers of its files only, so
the driver holds neither a list of files nor their schemas.  A file that cannot
be read gives one row with the error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

FOOTER = "path string, position int, column string, type string, error string"
#: key under which Spark keeps a file's own schema in its footer
ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"


def list_files(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """(path, length) of the files directly in ``folder``; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "false").load(folder).select("path", "length"))


def _fields(path: str) -> list[tuple[str, str]]:
    uri = re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):/(?!/)", r"\1:///", path)
    store, where = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
    with store.open_input_file(where) as source:
        schema = pq.read_schema(source)
    own = (schema.metadata or {}).get(ROW_METADATA)
    # what Spark itself reads: the schema it has written, else the file's own types
    spark = T.StructType.fromJson(json.loads(own)) if own else from_arrow_schema(schema, prefer_timestamp_ntz=True)
    return [(f.name, f.dataType.simpleString()) for f in spark.fields]


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for path in b["path"]:
            try:
                found = [(path, k, c, t, None) for k, (c, t) in enumerate(_fields(path))]
            except Exception as exc:   # an unreadable file is a finding, not a failed job
                found = [(path, None, None, None, f"{type(exc).__name__}: {str(exc).splitlines()[0][:200]}")]
            rows += found or [(path, None, None, None, None)]
        yield pd.DataFrame(rows, columns=["path", "position", "column", "type", "error"]).astype(
            {"position": "Int32"})


def footer_schemas(files: DataFrame) -> DataFrame:
    """(path, position, column, type, error) of every column of every file, read in parallel tasks."""
    return files.select("path").mapInPandas(_read, FOOTER)


def schema_differences(files: DataFrame, reference: dict[str, str]) -> DataFrame:
    """(path, column, ref_type, file_type, status, error): every file against a reference schema.

    status is same, missing, extra or retyped per column, or unreadable for the file.
    """
    per_file = footer_schemas(files).groupBy("path").agg(
        F.max("error").alias("error"),
        F.map_from_entries(F.filter(F.collect_list(F.struct("column", "type")), lambda x: x["column"].isNotNull()))
        .alias("m"))                                      # one map of its columns per file
    ref = F.create_map(*[F.lit(x) for kv in reference.items() for x in kv]).cast("map<string,string>")
    names = F.when(F.col("error").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(
        F.array_union(F.map_keys(ref), F.map_keys("m")))
    rows = per_file.select("path", "error", "m", F.explode(names).alias("column"))
    rows = rows.select("path", "column", F.try_element_at(ref, F.col("column")).alias("ref_type"),
                       F.try_element_at("m", F.col("column")).alias("file_type"), "error")
    status = (F.when(F.col("error").isNotNull(), "unreadable").when(F.col("ref_type").isNull(), "extra")
              .when(F.col("file_type").isNull(), "missing")
              .when(F.col("ref_type") != F.col("file_type"), "retyped").otherwise("same"))
    return rows.select("path", "column", "ref_type", "file_type", status.alias("status"), "error")


def file_schema(files: DataFrame) -> dict[str, str]:
    """{column: type} of the first readable file by name."""
    rows = footer_schemas(files).filter("error is null")
    first = rows.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("position", "column", "type"))).alias("c")
                                     ).agg(F.min_by("c", "path")).first()[0]
    return {r["column"]: r["type"] for r in first or [] if r["column"] is not None}
