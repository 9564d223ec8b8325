"""Operators against plain numpy/pandas brute force on small fixtures."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from orderlens.operators import association as A
from orderlens.operators import profile as P
from orderlens.operators.selection_exact import select_kth
from orderlens.plans.registry import model_facts
from orderlens.plans.scoring import hyperparameter_frame
from orderlens.plans.training import BoostParams


def _chi2(table: np.ndarray, yates: bool) -> float:
    rows, cols = table.sum(1, keepdims=True), table.sum(0, keepdims=True)
    expected = rows * cols / table.sum()
    obs = table.astype(float)
    if yates and table.shape == (2, 2):
        diff = expected - obs
        obs = obs + np.minimum(0.5, np.abs(diff)) * np.sign(diff)
    return float(((obs - expected) ** 2 / expected).sum())


def _cramers(x, y, yates=False, guard=True):
    t = pd.crosstab(x, y).to_numpy()
    if guard and (t.shape[0] < 2 or t.shape[1] < 2):
        return 0.0
    n = t.sum()
    r, k = t.shape
    n1 = max(1.0, n - 1.0) if guard else n - 1.0
    phi2 = _chi2(t, yates) / n
    phi2c = max(0.0, phi2 - (k - 1) * (r - 1) / n1)
    rc, kc = r - (r - 1) ** 2 / n1, k - (k - 1) ** 2 / n1
    d = min(rc - 1, kc - 1)
    if guard:
        d = max(1e-12, d)
        return math.sqrt(phi2c / d) if d > 0 else 0.0
    return 0.0 if d == 0 else math.sqrt(phi2c / d)


def _fixture(spark, n=800, seed=5):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        a = rnd.choice("xyz")
        b = a if rnd.random() < 0.6 else rnd.choice("pq")   # associated with a
        c = rnd.choice(["u", "v"])
        d = c if rnd.random() < 0.3 else rnd.choice(["u", "v"])
        rows.append((a, b if rnd.random() > 0.05 else None, c, d))
    return spark.createDataFrame(rows, "a string, b string, c string, d string")


def test_cramers_v_matches_bruteforce(spark):
    df = _fixture(spark)
    pdf = df.toPandas().fillna("__NA__")
    got = {(r["var_a"], r["var_b"]): r["cramers_v"]
           for r in A.cramers_v_matrix(df, ["a", "b", "c", "d"]).collect()}
    for (a, b), v in got.items():
        assert v == pytest.approx(_cramers(pdf[a], pdf[b]), abs=1e-12), (a, b)


def test_cramers_v_eda_yates_matches_bruteforce(spark):
    df = _fixture(spark)
    pdf = df.toPandas()
    got = {(r["var_a"], r["var_b"]): r["cramers_v"]
           for r in A.cramers_v_matrix(df, ["a", "b", "c", "d"], eda=True).collect()}
    for (a, b), v in got.items():
        sub = pdf[[a, b]].dropna()
        assert v == pytest.approx(_cramers(sub[a], sub[b], yates=True, guard=False), abs=1e-12)


def test_select_kth_matches_sorted(spark):
    rnd = random.Random(11)
    vals = [rnd.choice([1.0, 2.0, 2.0, 7.5]) if rnd.random() < 0.5 else rnd.gauss(0, 3)
            for _ in range(5000)]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(vals)], "v double, g int")
    s = {g: sorted(v for i, v in enumerate(vals) if i % 2 == g) for g in (0, 1)}
    ks = [0, 1, 17, 1250, 2499, 2500]
    targets = {f"{g}:{k}": ((g,), k) for g in (0, 1) for k in ks}
    got = select_kth(df, "v", targets, ["g"], buckets=8, finish_rows=50)
    for g in (0, 1):
        for k in ks:
            want = s[g][k] if k < len(s[g]) else None
            assert got[f"{g}:{k}"] == want


def test_histogram_matches_numpy(spark):
    rnd = random.Random(3)
    vals = [rnd.expovariate(0.1) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = sorted((r["bin"], r["n"]) for r in P.histogram(df, "x", 25).collect())
    counts, _ = np.histogram(vals, bins=25)
    assert [n for _, n in got] == counts.tolist()


def test_kde_close_to_exact_gaussian_kde(spark):
    rnd = random.Random(9)
    vals = np.array([rnd.gauss(5, 2) for _ in range(2000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = sorted((r["x"], r["density"]) for r in P.kde(df, "x", grid_size=50).collect())
    h = vals.std(ddof=1) * len(vals) ** -0.2
    for x, dens in got[::7]:
        exact = np.exp(-0.5 * ((x - vals) / h) ** 2).sum() / (len(vals) * h * math.sqrt(2 * math.pi))
        assert dens == pytest.approx(exact, rel=1e-3, abs=1e-6)


def test_hyperparameters_and_bundle(spark):
    rec = BoostParams(max_iter=10).record()
    frame = {r["param"]: r["value"] for r in hyperparameter_frame(spark, rec).collect()}
    assert frame["max_iter"] == "10" and frame["step_size"] == "0.05" and frame["max_depth"] == "6"

    class _Idx:
        labels = ["A", "B"]

        def hasParam(self, name):
            return name == "outputCol"

        def getParam(self, name):
            return name

        def isDefined(self, p):
            return True

        def getOrDefault(self, p):
            return "label_idx"

    class _Model:
        stages = [_Idx()]

    b = model_facts(_Model(), ["c1"], ["x1", "x2"])
    assert b == {"classes": ["A", "B"], "categorical": ["c1"], "inputs": ["c1", "x1", "x2"], "best_round": None}


def test_near_constant_matches_pandas(spark):
    df = spark.createDataFrame([("a", 1.0)] * 96 + [("b", 2.0)] * 3 + [(None, None)],
                               "s string, v double")
    got = {r["variable"]: (r["top_share"], r["drop"]) for r in A.near_constant(df, ["s", "v"]).collect()}
    pdf = df.toPandas()
    for c in ("s", "v"):
        share = (pdf[c].value_counts() / len(pdf)).max()
        assert got[c] == (pytest.approx(share), share >= 0.95)
