"""Properties of the operators: exactness, symmetry, conservation."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.operators import association as A
from orderlens.operators import evaluate as E
from orderlens.operators.joins import align_distributions
from orderlens.operators.ranking import exact_quantiles, global_rank
from orderlens.operators.split import balanced_weights, stratified_split
from orderlens.operators.validate import split_valid, validate_records
from orderlens.plans.catalog_ml import TEST_RULES, customer_records
from orderlens.sources.tables import table

from paths import SF_CHECK


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 else rnd.choice(["a", "b", "c"])  # one group holds 2/3 of rows
        v = 42.0 if rnd.random() < 0.4 else round(rnd.gauss(0, 10), 2)  # a hot value
        rows.append((i, g, v))
    return spark.createDataFrame(rows, "id long, g string, v double")


def test_global_rank_matches_row_number(spark):
    df = _skewed(spark)
    got = global_rank(df, ["v", "id"], ["g"], unique_order=True, num_partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")) - 1)
    a = {(r["id"]): (r["_rank"], r["_group_n"]) for r in got.collect()}
    n = dict(df.groupBy("g").count().collect())
    b = {r["id"]: (r["rn"], n[r["g"]]) for r in ref.collect()}
    assert a == b


def test_rank_with_ties_is_a_permutation(spark):
    df = _skewed(spark)
    got = global_rank(df, ["v"], ["g"], num_partitions=5)
    per = got.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("_rank").alias("d"),
                               F.min("_rank").alias("lo"), F.max("_rank").alias("hi")).collect()
    for r in per:
        assert r["n"] == r["d"] and r["lo"] == 0 and r["hi"] == r["n"] - 1


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    df = _skewed(spark)
    got = {r["g"]: r for r in exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["g"],
                                               num_partitions=6).collect()}
    pdf = df.toPandas()
    for g, sub in pdf.groupby("g"):
        for p in (0.1, 0.5, 0.9):
            assert got[g][f"q{int(p * 100)}"] == pytest.approx(np.quantile(sub.v, p), abs=1e-9)


def test_split_is_exact_disjoint_and_covering(spark):
    o = table(spark, SF_CHECK, "orders").select("o_orderkey", "o_orderstatus")
    sp = stratified_split(o, "o_orderstatus", ["o_orderkey"], seed=3)
    assert sp.count() == o.count()
    assert sp.select("o_orderkey").distinct().count() == o.count()
    sizes = {(r["o_orderstatus"], r["split"]): r["count"] for r in
             sp.groupBy("o_orderstatus", "split").count().collect()}
    for cls, n in o.groupBy("o_orderstatus").count().collect():
        assert sizes[(cls, "train")] == (6 * n) // 10
        assert sizes[(cls, "train")] + sizes[(cls, "val")] == (8 * n) // 10
    again = stratified_split(o, "o_orderstatus", ["o_orderkey"], seed=3)
    assert sp.exceptAll(again).count() == 0
    other = stratified_split(o, "o_orderstatus", ["o_orderkey"], seed=4)
    assert sp.exceptAll(other).count() > 0


@pytest.mark.parametrize("keys,content", [(4, 1), (1, 1), (4, 700), (1, 50)])
def test_split_is_exact_on_repeated_keys(spark, keys, content):
    n = 30_000                      # more rows on one key than one selection round reads out
    df = spark.range(n).select((F.col("id") % keys).alias("k"), (F.col("id") % content).alias("v"),
                               F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("y"))
    sp = stratified_split(df, "y", ["k"], seed=1)
    sizes = {(r["y"], r["split"]): r["count"] for r in sp.groupBy("y", "split").count().collect()}
    assert sizes == {("a", "train"): 16_200, ("a", "val"): 5_400, ("a", "test"): 5_400,
                     ("b", "train"): 1_800, ("b", "val"): 600, ("b", "test"): 600}
    assert sp.drop("split").exceptAll(df).count() == 0


def test_kde_with_an_outlier_matches_the_plain_sum(spark):
    from orderlens.operators.profile import kde
    rnd = random.Random(5)
    vals = [rnd.gauss(0, 1) for _ in range(4000)] + [3000.0]
    got = kde(spark.createDataFrame([(v,) for v in vals], "v double"), "v").collect()
    mean = sum(vals) / len(vals)
    h = (sum((v - mean) ** 2 for v in vals) / (len(vals) - 1)) ** 0.5 * len(vals) ** -0.2
    for r in got[:6] + got[-6:]:
        want = sum(math.exp(-0.5 * ((r["x"] - v) / h) ** 2) for v in vals) / (
            len(vals) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want, rel=2e-2, abs=1e-9)


def test_balanced_weights_sum_to_n(spark):
    df = _skewed(spark)
    w = balanced_weights(df, "g")
    total = w.agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(df.count())
    per = {r["g"]: r["s"] for r in w.groupBy("g").agg(F.sum("weight").alias("s")).collect()}
    k = len(per)
    for s in per.values():
        assert s == pytest.approx(df.count() / k)


def test_cramers_v_range_and_symmetry(spark):
    df = _skewed(spark).withColumn("h", (F.col("id") % 4).cast("string")) \
        .withColumn("v2", F.col("v").cast("string"))
    m1 = {(r["var_a"], r["var_b"]): r["cramers_v"] for r in
          A.cramers_v_matrix(df, ["g", "h", "v2"]).collect()}
    m2 = {(r["var_b"], r["var_a"]): r["cramers_v"] for r in
          A.cramers_v_matrix(df, ["v2", "h", "g"]).collect()}
    for k, v in m1.items():
        assert 0.0 <= v <= 1.0
        assert v == pytest.approx(m2[k], abs=1e-12)
    same = [r["cramers_v"] for r in A.cramers_v_matrix(
        df.withColumn("g2", F.col("g")), ["g", "g2"]).collect()]
    assert same == [pytest.approx(1.0)]


def test_pairs_of_many_levels_are_decided(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("a"), (F.col("id") + 1).cast("string").alias("b"))
    assert A.cramers_v_matrix(df, ["a", "b"]).collect()[0]["cramers_v"] is not None
    kept, dropped = A.greedy_redundancy(["g", "idc"], {("g", "idc"): None}, 0.8)
    assert kept == ["g", "idc"] and dropped == []


def test_greedy_rules():
    assoc = {("a", "b"): 0.9, ("a", "c"): 0.1, ("b", "c"): 0.95}
    assert A.greedy_redundancy(["a", "b", "c"], assoc, 0.8) == (["a", "c"], ["b"])
    corr = {("a", "b"): -0.85, ("a", "c"): 0.2, ("b", "c"): 0.99}
    dropped, groups = A.greedy_correlated(["a", "b", "c"], corr, 0.8)
    assert dropped == ["b"] and groups == [{"a", "b"}]


def test_confusion_total_and_report(spark):
    rows = [(0, 0), (0, 1), (1, 1), (2, 2), (2, 2), (1, 0)]
    df = spark.createDataFrame(rows, "y int, p int")
    cm = E.confusion_counts(df, "y", "p", ["a", "b", "c"])
    assert cm.count() == 9
    assert cm.agg(F.sum("n")).first()[0] == len(rows)
    rep = {r["scope"]: r for r in E.per_class_report(cm).collect()}
    assert rep["0"]["precision"] == pytest.approx(0.5)
    assert rep["2"]["f1"] == pytest.approx(1.0)
    assert rep["weighted avg"]["support"] == len(rows)


def test_valid_plus_quarantine_is_input(spark):
    recs = customer_records(spark, SF_CHECK)
    valid, bad = split_valid(validate_records(recs, TEST_RULES))
    assert valid.count() + bad.count() == recs.count()
    assert bad.filter(F.size("errors") == 0).count() == 0


def test_align_golden_distributions(spark):
    # the reference's committed run: predictions 32/14/4, truth 26/7/17
    pred = spark.createDataFrame([("DIGITAL", 32), ("TELEFONO", 14), ("VENDEDOR", 4)],
                                 "class string, n long")
    truth = spark.createDataFrame([("VENDEDOR", 17), ("DIGITAL", 26), ("TELEFONO", 7),
                                   ("OTRO", 1)], "class string, n long")
    got = [tuple(r) for r in align_distributions(pred, truth, "class", "n")
           .orderBy("position").collect()]
    assert got == [("DIGITAL", 26, False, 1), ("TELEFONO", 7, False, 2),
                   ("VENDEDOR", 17, False, 3), ("OTRO", 1, True, 4)]
