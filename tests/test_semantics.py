"""Hand-made rows for the missing-value, tie and de-dup rules."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from orderlens.config import CastConfig, RollupSpec, TransactionSchema
from orderlens.functions.scalar import to_numeric, truncate_to_int, weekday_monday0, with_na_token
from orderlens.operators.cast import require_columns, validate_and_cast
from orderlens.operators.rollup import aggregate_to_customer, keep_last_per_key
from orderlens.sources.parquet import (file_row_report, read_parquet_folder, schema_report,
                                       write_processed)

SCHEMA = TransactionSchema(key="k", date="d", label="lab", tiebreak="t")
SPEC = RollupSpec({"a": "first", "s": "sum", "d": "max", "lab": "last"})
D = dt.datetime


def _tx(spark, rows):
    return spark.createDataFrame(
        rows, "k string, t long, d timestamp_ntz, a string, s double, lab string")


def test_first_last_skip_missing_and_null_dates_sort_last(spark):
    rows = [
        ("c1", 1, D(2024, 1, 1), None, 1.0, "X"),
        ("c1", 2, D(2024, 1, 2), "first", float("nan"), None),
        ("c1", 3, None, "late", 2.0, "Z"),       # null date sorts last -> 'last' label
        ("c1", 4, D(2024, 1, 3), "mid", None, "Y"),
        ("c2", 5, D(2024, 2, 1), None, None, None),
        (None, 6, D(2024, 3, 1), "nokey", 5.0, "Q"),  # null key dropped
    ]
    out = {r["k"]: r for r in aggregate_to_customer(_tx(spark, rows), SPEC, SCHEMA).collect()}
    assert set(out) == {"c1", "c2"}
    assert out["c1"]["a"] == "first"
    assert out["c1"]["lab"] == "Z"
    assert out["c1"]["s"] == 3.0          # NaN and null skipped
    assert out["c1"]["d"] == D(2024, 1, 3)
    assert out["c2"]["s"] == 0.0          # all missing -> 0
    assert out["c2"]["a"] is None and out["c2"]["lab"] is None


def test_ties_on_key_and_date_use_tiebreak(spark):
    rows = [("c", 2, D(2024, 1, 1), "b", 1.0, "B"), ("c", 1, D(2024, 1, 1), "a", 1.0, "A")]
    r = aggregate_to_customer(_tx(spark, rows), SPEC, SCHEMA).first()
    assert (r["a"], r["lab"]) == ("a", "B")


def test_required_columns(spark):
    with pytest.raises(KeyError):
        require_columns(_tx(spark, []), ["missing_col"])
    with pytest.raises(KeyError):
        aggregate_to_customer(_tx(spark, []).drop("a"), SPEC, SCHEMA)


def test_keep_last_per_key(spark):
    df = spark.createDataFrame([("u", 1, "x"), ("u", 3, "z"), ("u", 2, "y"), ("v", 1, "q")],
                               "u string, ts int, v string")
    got = {r["u"]: r["v"] for r in keep_last_per_key(df, ["u"], ["ts"]).collect()}
    assert got == {"u": "z", "v": "q"}


def test_numeric_coercion(spark):
    df = spark.createDataFrame([("abc",), (" 3 ",), ("1.0d",), ("",), ("2.7",), ("-1e2",), (None,)],
                               "x string")
    got = [r[0] for r in df.select(to_numeric("x")).collect()]
    assert got == [None, 3.0, None, None, 2.7, -100.0, None]
    ints = [r[0] for r in df.select(truncate_to_int("x")).collect()]
    assert ints == [None, 3, None, None, 2, -100, None]


def test_validate_and_cast_strict_fallback(spark):
    df = spark.createDataFrame([("1", "5"), ("x", "6")], "a string, b string")
    out = validate_and_cast(df, CastConfig(dtype_map={"a": "int", "b": "int", "zz": "int"}))
    assert dict(out.dtypes) == {"a": "string", "b": "int"}   # 'a' kept: a value fails
    with pytest.raises(ValueError):
        validate_and_cast(df.limit(0), CastConfig(dtype_map={"a": "int"}))
    same = validate_and_cast(df.limit(0), CastConfig(dtype_map={"a": "int"}, fail_if_empty=False))
    assert same.columns == ["a", "b"]


def test_weekday_is_monday_zero(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 7),)], "d timestamp_ntz")
    assert [r[0] for r in df.select(weekday_monday0("d")).collect()] == [0, 6]


def test_na_token(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.5,)], "x double")
    assert [r[0] for r in df.select(with_na_token("x")).collect()] == ["__NA__", "__NA__", "1.5"]


def test_per_file_dedup_keeps_cross_file_copies(spark, scratch):
    rows = [(1, "a"), (1, "a"), (2, "b")]
    df = spark.createDataFrame(rows, "id int, v string").coalesce(1)
    for name in ("p1", "p2"):
        df.write.mode("overwrite").parquet(os.path.join(scratch, name))
    folder = os.path.join(scratch, "raw")
    os.makedirs(folder)
    for name in ("p1", "p2"):
        part = [f for f in os.listdir(os.path.join(scratch, name)) if f.endswith(".parquet")][0]
        os.link(os.path.join(scratch, name, part), os.path.join(folder, f"{name}.parquet"))
    stacked = read_parquet_folder(spark, folder)
    assert stacked.count() == 4          # 2 per file; copies across files survive
    assert stacked.distinct().count() == 2
    rep = {r["file_name"]: r["n_rows"] for r in
           file_row_report(read_parquet_folder(spark, folder, keep_source=True)).collect()}
    assert rep == {"p1.parquet": 2, "p2.parquet": 2, "__total__": 4}
    sch = schema_report(spark, folder)
    assert {r["status"] for r in sch.collect()} == {"same"}


def test_missing_folder_raises(spark, scratch):
    with pytest.raises(FileNotFoundError):
        read_parquet_folder(spark, os.path.join(scratch, "nope"))
    os.makedirs(os.path.join(scratch, "empty"))
    with pytest.raises(FileNotFoundError):
        read_parquet_folder(spark, os.path.join(scratch, "empty"))


def test_write_processed_rejects_empty(spark, scratch):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        write_processed(df.limit(0), os.path.join(scratch, "o"))
    assert write_processed(df, os.path.join(scratch, "o2")).endswith("o2")
    assert spark.read.parquet(os.path.join(scratch, "o2")).count() == 1


def test_nan_is_not_a_number(spark):
    assert math.isnan(float("nan"))
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert df.select(F.sum(F.nanvl("x", F.lit(None).cast("double")))).first()[0] == 1.0


def test_numbers_and_text_keep_their_values(spark):
    from orderlens.config import CastConfig
    from orderlens.functions.scalar import with_na_token
    from orderlens.operators.cast import validate_and_cast
    from orderlens.operators.profile import category_counts
    df = spark.createDataFrame([(float("inf"), "NaN"), (1.5, None)], "x double, t string")
    got = validate_and_cast(df, CastConfig(dtype_map={"x": "float64"})).collect()
    assert sorted(r["x"] for r in got) == [1.5, float("inf")]
    assert {r[0] for r in df.select(with_na_token("t")).collect()} == {"NaN", "__NA__"}
    assert {r[0] for r in df.select(with_na_token(F.nanvl("x", F.lit(0.0)))).collect()} == {"Infinity", "1.5"}
    assert [r["value"] for r in category_counts(df, ["t"]).collect()] == ["NaN"]


def test_typify_query_counts_every_numeric_column_in_full(spark, scratch):
    from orderlens.plans.catalog_profile import ORACLE, QUERIES
    rows = [(k, k % 7, None if k % 10 == 0 else k % 3, [0.0, -0.0, float("nan"), 1.5][k % 4], "AB"[k % 2], D(2024, 1, 1 + k % 28))
            for k in range(200)] + [(5, 5, 2, 1.5, "A", D(2024, 1, 1))] * 2
    cols = "l_orderkey long, l_partkey long, l_linenumber int, l_tax double, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, cols).write.parquet(os.path.join(scratch, "lineitem.parquet"))
    got = {r["variable"]: (r["n_distinct"], r["kind"]) for r in QUERIES["f1_typify_lineitem"](spark, scratch).collect()}
    assert got == {"l_orderkey": (200, "continuous"), "l_partkey": (7, "continuous"), "l_linenumber": (4, "discrete"),
                   "l_tax": (3, "discrete"), "l_returnflag": (None, "categorical"), "l_shipdate": (None, "temporal")}
    assert "<= 5 THEN (count" not in ORACLE["f1_typify_lineitem"]


def test_read_folder_files_follow_the_rows(spark, scratch, monkeypatch):
    from orderlens.plans import catalog_rollup as R
    rows = [(k, float(k % 5)) for k in range(300)] + [(6, 1.0)] * 40 + [(7, None), (None, 2.0), (None, 2.0)]
    spark.createDataFrame(rows, "o_orderkey long, v double").write.parquet(os.path.join(scratch, "orders.parquet"))
    monkeypatch.setattr(R, "FILE_ROWS", 50)
    got = R.QUERIES["s1_read_folder"](spark, scratch)
    per_file = [r["n"] for r in read_parquet_folder(spark, os.path.dirname(got.inputFiles()[0]), per_file_dedup=False,
                                                    keep_source=True).groupBy("_source_file").agg(F.count("*").alias("n")).collect()]
    assert len(per_file) > 3 * 4 and max(per_file) < 200
    once = set(rows)
    want = [*once, *once, *(r for r in once if r[0] is not None and r[0] % 3 == 0)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
