"""Model table, file schemas, streams, bounded distinct counts and one-pass metrics."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from orderlens.operators import association as A
from orderlens.operators import evaluate as E
from orderlens.operators.joins import align_distributions, lookup_join
from orderlens.operators.profile import bounded_distinct
from orderlens.operators.quantiles_grouped import grouped_quantiles
from orderlens.plans import registry
from orderlens.sources.footers import footer_schemas, list_files
from orderlens.sources.parquet import schema_report
from orderlens.streaming.windows import stream_scores, stream_windowed_counts
from paths import SF_CHECK


# --- model table -----------------------------------------------------------

def names(spark, *rows):
    return spark.createDataFrame(rows, "name string, path string")


def test_versions_promotion_and_bundle(spark, scratch):
    root = os.path.join(scratch, "models")
    assert registry.current(spark, root).count() == 0
    with pytest.raises(LookupError):
        registry.resolve_model_path(registry.current(spark, root), "m")
    registry.register(names(spark, ("m", "/m/1"), ("x", "/x/1")), root)
    facts = spark.createDataFrame([("m", "/m/2", ["A", "B"], ["c"], ["c", "n"], 7)],
                                  "name string, path string, classes array<string>, categorical array<string>, "
                                  "inputs array<string>, best_round int")
    registry.register(facts, root)
    registry.register(names(spark, ("m", "/m/3")), root)
    assert registry.resolve_model_path(registry.current(spark, root), "m") == "/m/3"      # nothing promoted yet
    registry.promote(spark.createDataFrame([("m", 1)], "name string, version int"), root)
    registry.promote(spark.createDataFrame([("m", 2)], "name string, version int"), root)
    state = {(r["name"], r["version"]): r["stage"] for r in registry.current(spark, root).collect()}
    assert state == {("m", 1): "Archived", ("m", 2): "Production", ("m", 3): "None", ("x", 1): "None"}
    assert registry.model_bundle(spark, root, "m") == {
        "version": 2, "stage": "Production", "path": "/m/2", "classes": ["A", "B"], "categorical": ["c"],
        "inputs": ["c", "n"], "best_round": 7}
    with pytest.raises(LookupError):
        registry.promote(spark.createDataFrame([("m", 9)], "name string, version int"), root)
    assert registry.log_rows(spark, root).count() == 7                                    # nothing was overwritten


def test_two_writers_do_not_share_a_commit(spark, scratch):
    root = os.path.join(scratch, "models")
    first = names(spark, ("m", "/m/1")).withColumns({
        "version": F.lit(1), "stage": F.lit("None"), "best_round": F.lit(None).cast("int"),
        **{c: F.lit(None).cast("array<string>") for c in ("classes", "categorical", "inputs")}})
    registry._commit(first, root, 1)
    with pytest.raises(registry.ConflictError):
        registry._commit(first, root, 1)
    os.makedirs(os.path.join(root, "claims"), exist_ok=True)
    open(os.path.join(root, "claims", "0000000002"), "w").close()        # a writer that died after its claim
    assert registry.register(names(spark, ("m", "/m/2")), root) == 3
    assert [r["version"] for r in registry.current(spark, root).orderBy("version").collect()] == [1, 2]


# --- file schemas ------------------------------------------------------------

def test_schema_report_finds_every_kind_of_drift(spark, scratch):
    def put(df, name):
        df.coalesce(1).write.parquet(f"{scratch}/make-{name}")
        part = next(f for f in os.listdir(f"{scratch}/make-{name}") if f.endswith(".parquet"))
        os.makedirs(f"{scratch}/in", exist_ok=True)
        os.rename(f"{scratch}/make-{name}/{part}", f"{scratch}/in/{name}.parquet")
    base = spark.createDataFrame([(1, "x", 1.5)], "a long, b string, c double")
    put(base, "0")
    put(base.withColumn("a", F.col("a").cast("int")), "1")
    put(base.drop("b").withColumn("d", F.lit(True)), "2")
    with open(f"{scratch}/in/3.parquet", "w") as f:
        f.write("no parquet")
    got = {(r["file_name"], r["column"]): r["status"] for r in schema_report(spark, f"{scratch}/in").collect()}
    assert got == {("0.parquet", "a"): "same", ("0.parquet", "b"): "same", ("0.parquet", "c"): "same",
                   ("1.parquet", "a"): "retyped", ("1.parquet", "b"): "same", ("1.parquet", "c"): "same",
                   ("2.parquet", "a"): "same", ("2.parquet", "b"): "missing", ("2.parquet", "c"): "same",
                   ("2.parquet", "d"): "extra", ("3.parquet", None): "unreadable"}
    with pytest.raises(FileNotFoundError):
        os.makedirs(f"{scratch}/none")
        schema_report(spark, f"{scratch}/none")


def test_footer_types_are_those_that_spark_reads(spark):
    for t in ("orders", "embeddings", "events", "conversations"):
        files = list_files(spark, SF_CHECK, f"{t}.parquet")
        got = {r["column"]: r["type"] for r in footer_schemas(files).collect()}
        assert got == dict(spark.read.parquet(f"{SF_CHECK}/{t}.parquet").dtypes)


# --- streams -----------------------------------------------------------------

def test_stream_keeps_unfit_files_and_bad_records_out(spark, scratch):
    src, out = f"{scratch}/in", f"{scratch}/out-{uuid.uuid4().hex}"
    good = spark.createDataFrame([(k, float(k)) for k in range(20)], "id long, v double")
    good.repartition(2).write.parquet(src)
    with open(f"{src}/zz.parquet", "w") as f:
        f.write("broken")
    score = lambda b: (b.filter("v < 15"), b.filter("v >= 15"))      # noqa: E731
    a, bad = stream_scores(spark, src, score, schema="id long, v double", out_path=out)
    spark.createDataFrame([(99, "1")], "id long, v string").coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(50, 1.0)], "id long, v double").coalesce(1).write.mode("append").parquet(src)
    for _ in range(2):
        stream_scores(spark, src, score, schema="id long, v double", out_path=out)
    assert sorted(r["id"] for r in spark.read.parquet(a).collect()) == [*range(15), 50]
    assert sorted(r["id"] for r in spark.read.parquet(bad).collect()) == list(range(15, 20))
    reasons = sorted(r["reasons"][0].split(" ")[0] for r in spark.read.parquet(f"{bad}-files").collect())
    assert reasons == ["unreadable:", "v:"]


def test_append_windows_close_once_and_drop_late_rows(spark, scratch):
    src, out = f"{scratch}/ev", f"{scratch}/win"

    def wave(*rows):
        (spark.createDataFrame([(t, k) for t, k in rows], "ts string, k string")
         .select(F.col("ts").cast("timestamp_ntz").alias("ts"), "k").coalesce(1).write.mode("append").parquet(src))
        stream_windowed_counts(spark, src, "ts", "k", window="1 day", watermark="1 hour", mode="append", out_path=out)
        return sorted((str(r["window_start"])[:10], r["k"], r["n"]) for r in spark.read.schema(
            "window_start timestamp_ntz, window_end timestamp_ntz, k string, n long").parquet(out).collect())
    assert wave(("2024-01-01 10:00:00", "a"), ("2024-01-01 11:00:00", "a"), ("2024-01-02 00:30:00", "a")) == []
    closed = [("2024-01-01", "a", 2)]
    assert wave(("2024-01-02 05:00:00", "b")) == closed
    late = wave(("2024-01-01 12:00:00", "a"), ("2024-01-02 06:00:00", "a"))      # the first is late, the second not
    assert late == closed
    assert wave(("2024-01-03 09:00:00", "a")) == [*closed, ("2024-01-02", "a", 2), ("2024-01-02", "b", 1)]


# --- bounded distinct counts, near-constant columns, positions, metrics -----------------

def test_bounded_distinct_stops_counting(spark):
    rows = [(k, k % 5, float(k % 4) if k % 4 else None, float("nan") if k % 3 else 1.0, 2 ** 60 + k % 6, None)
            for k in range(500)]
    df = spark.createDataFrame(rows, "a long, b int, c double, d double, e long, f int").repartition(7)
    assert bounded_distinct(df, df.columns, 5) == {"a": 6, "b": 5, "c": 4, "d": 2, "e": 6, "f": 1}
    plan = df.agg(F.size(F.histogram_numeric("a", F.lit(6))))._jdf.queryExecution().toString()
    assert "Expand" not in plan
    assert bounded_distinct(df.limit(0), ["a", "c"], 5) == {"a": 0, "c": 0}


def test_near_constant_by_candidates(spark):
    rows = [("x" if k % 50 else f"r{k}", k, None if k % 10 else 1, None) for k in range(2000)]
    df = spark.createDataFrame(rows, "a string, b long, c int, d string").repartition(5)
    got = {r["variable"]: (round(r["top_share"], 6), r["drop"]) for r in A.near_constant(df, df.columns).collect()}
    assert got["a"] == (0.98, True) and got["c"] == (0.1, False) and "d" not in got
    assert got["b"][1] is False and got["b"][0] <= 0.0005


def test_quantiles_of_many_groups_with_ties_and_null(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(0)
    n = 30_000
    g = np.where(rng.random(n) < 0.5, "hot", np.where(rng.random(n) < 0.5, None, rng.integers(0, 3000, n).astype(str)))
    x = np.where(rng.random(n) < 0.3, 7.0, np.exp(rng.normal(size=n) * 3))      # ties and a heavy tail
    pdf = pd.DataFrame({"g": g, "v": x})
    got = grouped_quantiles(spark.createDataFrame(pdf), "v", [0.1, 0.5, 0.99], ["g"], finish=300,
                            extra=[F.max("_v").alias("top")]).toPandas()
    got = got.assign(g=got.g.fillna("~")).set_index("g")
    per = pdf.assign(g=pdf.g.fillna("~")).groupby("g").v
    want = per.quantile([0.1, 0.5, 0.99]).unstack()
    assert np.abs(got.loc[want.index, ["q10", "q50", "q99"]].to_numpy() - want.to_numpy()).max() == 0
    assert (got.top == per.max().loc[got.index]).all() and (got.n == per.size().loc[got.index]).all()


def test_lookup_rows_are_read_once(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 7)
    small = big.groupBy("k").agg(F.count("*").alias("n"))
    plan = lookup_join(big, small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Aggregate" not in plan and plan.count("Range (") == 1
    assert lookup_join(big, small, "k", max_rows=3).count() == 100


def test_positions_without_a_single_window(spark):
    t = spark.createDataFrame([(f"k{i:04d}", i) for i in range(0, 3000, 2)], "class string, n long")
    s = spark.createDataFrame([(f"k{i:04d}", i) for i in range(0, 3000, 3)], "class string, n long")
    got = align_distributions(t, s).orderBy("position").collect()
    keys = [f"k{i:04d}" for i in range(0, 3000, 2)] + [f"k{i:04d}" for i in range(3, 3000, 6)]
    assert [r["class"] for r in got] == keys and [r["position"] for r in got] == list(range(1, len(keys) + 1))


def test_metrics_of_empty_classes_and_bad_width(spark):
    rows = [("t", 0, 0, [0.9, 0.1, 0.0]), ("t", 0, 1, [0.4, 0.6]), ("v", 1, 1, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "split string, y int, p int, probs array<double>")
    got = {(r["split"], r["metric"], r["class"]): r["value"]
           for r in E.evaluate_splits(df, "y", "p", "probs", ["A", "B", "C"]).collect()}
    assert got["t", "bad_width", None] == 1 and got["t", "accuracy", None] == 0.5 and got["t", "rows", None] == 2
    assert got["t", "recall", "A"] == 0.5 and got["t", "precision", "B"] == 0 and got["v", "support", "C"] == 0
    assert got["v", "macro_f1", None] == pytest.approx(1 / 3) and got["v", "weighted_f1", None] == 1
