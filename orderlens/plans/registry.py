"""Versioned model table (M6, M7): append-only commits of registrations and promotions.

Every commit is a numbered folder of rows and is never changed.  A commit claims
its number by creating a marker file that must not exist yet, so of two writers
one goes on and the other takes the next number, after looking at the table
again.  A claim without rows is a writer that died; readers see no such commit.
The state of a version is its latest row (``max_by`` of the commit number), so
promoting is writing one more row, and any earlier state can still be read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAMES = T.ArrayType(T.StringType())
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("commit", T.LongType()), ("name", T.StringType()), ("version", T.IntegerType()), ("stage", T.StringType()),
    ("path", T.StringType()), ("classes", _NAMES), ("categorical", _NAMES), ("inputs", _NAMES),
    ("best_round", T.IntegerType()))])
_FACTS = ("path", "classes", "categorical", "inputs", "best_round")


class ConflictError(RuntimeError):
    """Another writer committed first."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _commits(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed folders, from one listing."""
    fs, p = _fs(spark, f"{root}/commits")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    done = [n for n in names if fs.exists(_fs(spark, f"{root}/commits/{n}/_SUCCESS")[1])]
    return sorted(int(n) for n in done)


def log_rows(spark: SparkSession, root: str) -> DataFrame:
    """Every row of every commit."""
    folders = [f"{root}/commits/{n:010d}" for n in _commits(spark, root)]
    return spark.read.schema(SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], SCHEMA)


def current(spark: SparkSession, root: str) -> DataFrame:
    """(name, version, stage, path, classes, categorical, inputs, best_round): the latest state."""
    rows = log_rows(spark, root)
    return rows.groupBy("name", "version").agg(*[F.max_by(c, "commit").alias(c) for c in ("stage", *_FACTS)])


def _commit(rows: DataFrame, root: str, number: int) -> int:
    """Write ``rows`` as commit ``number``; ConflictError if somebody has claimed it."""
    spark = rows.sparkSession
    fs, claim = _fs(spark, f"{root}/claims/{number:010d}")
    try:
        fs.create(claim, False).close()
    except Exception as exc:            # the marker exists: the number is taken
        if fs.exists(claim):
            raise ConflictError(f"commit {number} is taken") from exc
        raise
    rows.withColumn("commit", F.lit(number).cast("long")).select(*SCHEMA.names).write.parquet(
        f"{root}/commits/{number:010d}")
    return number


def _append(spark: SparkSession, root: str, make, attempts: int = 20) -> int:
    """Commit ``make()`` under the next free number; after a conflict it is made again from the new state."""
    fs, claims = _fs(spark, f"{root}/claims")
    for _ in range(attempts):
        taken = [int(s.getPath().getName()) for s in fs.listStatus(claims)] if fs.exists(claims) else []
        try:
            return _commit(make(), root, max([0, *taken, *_commits(spark, root)]) + 1)
        except ConflictError:
            continue
    raise ConflictError(f"no free commit number in {attempts} attempts")


def register(models: DataFrame, root: str, stage: str = "None") -> int:
    """Add versions: ``models`` holds name and path, and may hold ``order`` (several of one name),
    classes, categorical, inputs and best_round.  A name's versions go on where they end."""
    spark = models.sparkSession
    types = {f.name: f.dataType for f in SCHEMA.fields}
    have = models.select("name", (F.col("order") if "order" in models.columns else F.lit(0)).alias("order"),
                         *[(F.col(c) if c in models.columns else F.lit(None)).cast(types[c]).alias(c) for c in _FACTS])

    def make():
        last = log_rows(spark, root).groupBy("name").agg(F.max("version").alias("last"))
        # the place of a new row among those of its name: a few rows per name
        rank = F.expr("row_number() OVER (PARTITION BY name ORDER BY `order`, path)")
        return (have.join(last, "name", "left")
                .withColumn("version", (F.coalesce("last", F.lit(0)) + rank).cast("int"))
                .withColumn("stage", F.lit(stage)))
    return _append(spark, root, make)


def promote(choices: DataFrame, root: str, stage: str = "Production", archive: str = "Archived") -> int:
    """Give the (name, version) rows of ``choices`` a stage; who held it before is archived, in the same commit."""
    spark = choices.sparkSession
    wanted = choices.select("name", F.col("version").cast("int").alias("version"), F.lit(True).alias("wanted"))

    def make():
        now = current(spark, root)
        unknown = wanted.join(now, ["name", "version"], "left_anti")
        if not unknown.isEmpty():
            raise LookupError(f"no such model versions: {[tuple(r)[:2] for r in unknown.take(5)]}")
        names = wanted.select("name").distinct()
        got = now.join(wanted, ["name", "version"], "left").join(names, "name", "left_semi")
        held = F.col("wanted").isNull() & (F.col("stage") == stage)
        return got.filter(F.col("wanted").isNotNull() | held).withColumn(
            "stage", F.when(held, archive).otherwise(stage))
    return _append(spark, root, make)


def resolve_all(models: DataFrame, preferred_stage: str | None = "Production") -> DataFrame:
    """One row per name (M6): the highest version in the preferred stage, else the highest version."""
    staged = F.col("stage").eqNullSafe(F.lit(preferred_stage)).cast("int")
    return (models.groupBy("name").agg(F.max_by(F.struct(*[c for c in models.columns if c != "name"]),
                                                F.struct(staged, "version")).alias("m"))
            .select("name", "m.*"))


def resolve_model_path(models: DataFrame, name: str, preferred_stage: str | None = "Production") -> str:
    """The path that :func:`resolve_all` picks for one name."""
    row = resolve_all(models.filter(F.col("name") == name), preferred_stage).first()
    if row is None or row["path"] is None:
        raise LookupError(f"no stored versions of model {name!r}")
    return row["path"]


def model_facts(model, categorical: list[str], continuous: list[str]) -> dict:
    """What the table keeps of a fitted PipelineModel: class names, columns, best round."""
    from orderlens.plans.training import class_names
    last = model.stages[-1]
    return {"classes": class_names(model), "categorical": list(categorical),
            "inputs": [*categorical, *continuous], "best_round": getattr(last, "best_round", None)}


def model_bundle(spark: SparkSession, root: str, name: str, preferred_stage: str | None = "Production") -> dict:
    """Class names, categorical columns, input columns, best round and version of a stored model (M7).

    They come from the table; what an older registration did not write comes
    from the stored model: classes from its label indexer, columns from its encoders.
    """
    row = resolve_all(current(spark, root).filter(F.col("name") == name), preferred_stage).first()
    if row is None:
        raise LookupError(f"no stored versions of model {name!r}")
    got = row.asDict()
    if any(got[c] is None for c in ("classes", "categorical", "inputs")):
        from pyspark.ml import PipelineModel

        from orderlens.plans.training import class_names, encoder_columns
        model = PipelineModel.load(got["path"])
        cats, conts = encoder_columns(model)
        for c, v in (("classes", class_names(model)), ("categorical", cats), ("inputs", [*cats, *conts])):
            got[c] = v if got[c] is None else got[c]
    return {k: got[k] for k in ("version", "stage", "path", "classes", "categorical", "inputs", "best_round")}
