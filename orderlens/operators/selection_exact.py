"""Exact order statistics by counting, without sorting the data.

To find the k-th smallest value of a column (per group) exactly, keep a
search interval [lo, hi] (inclusive, always the exact min / max of the rows
inside it) and the rank k inside it:

1. one pass tags each row with the live interval that contains it (live
   intervals of a group are disjoint) and computes count / min / max per
   (interval, bucket), where the bucket is
   an equal-width slice of [lo, hi] - plain arithmetic inside whole-stage
   codegen, combined map-side, at most B rows per interval reach the
   driver;
2. the bucket holding rank k becomes the next interval, with its own exact
   min / max, so the interval is always tight;
3. an interval whose min = max is the answer (a hot value that holds a
   third of all rows is settled the moment it is alone in a bucket); an
   interval with at most ``finish_rows`` rows is finished by collecting its
   (value[, payload], count) pairs and walking them in order;
4. if a round fails to halve an interval (heavy tails), the next round cuts
   it at approximate-quantile bounds instead (binary search per row), so
   the number of rounds stays logarithmic.

Rows never move through a shuffle, no task holds a whole group, and only
O(B) numbers per interval reach the driver per round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed defaults: buckets per round and the size at which a bucket is read out.
BUCKETS = 1000
FINISH_ROWS = 10_000


def with_bucket(df: DataFrame, v: str, bounds: str, max_len: int, out: str = "_bk") -> DataFrame:
    """Add ``out`` = 2*(#bounds < v) + (v == next bound).

    Binary search over the sorted ``bounds`` array as ONE ``aggregate``
    over the halving steps (log2(B) comparisons per row); written as a fold
    so the expression stays the same size whatever the number of steps.
    """
    steps, step = [], 1
    while step * 2 <= max(max_len, 1):
        step *= 2
    while step >= 1:
        steps.append(step)
        step //= 2
    b, val = F.col(bounds), F.col(v)

    def probe(acc, st):
        cand = acc + st
        return F.when((cand <= F.size(b)) & (F.try_element_at(b, cand) < val), cand).otherwise(acc)
    ix = F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), probe)
    df = df.withColumn("_ix", ix)
    nxt = F.try_element_at(b, F.col("_ix") + 1)
    eq = F.when(nxt.isNotNull() & (nxt == val), 1).otherwise(0)
    return df.withColumn(out, F.col("_ix") * 2 + eq).drop("_ix")


def _inside(v: Column, s: dict) -> Column:
    cond = F.lit(True)
    if s["lo"] is not None:
        cond = cond & ((v >= F.lit(s["lo"])) if s["lo_eq"] else (v > F.lit(s["lo"])))
    if s["hi"] is not None:
        cond = cond & ((v <= F.lit(s["hi"])) if s["hi_eq"] else (v < F.lit(s["hi"])))
    return cond


def _group_match(group_cols: Sequence[str], g: tuple) -> Column:
    cond = F.lit(True)
    for c, val in zip(group_cols, g):
        cond = cond & F.col(c).eqNullSafe(F.lit(val))
    return cond


def _width_bucket(v: Column, lo: float, hi: float, buckets: int) -> Column:
    if hi <= lo:
        return F.lit(0)
    return F.least(F.floor((v - F.lit(lo)) / F.lit(hi - lo) * F.lit(buckets)),
                   F.lit(buckets - 1)).cast("int")


def select_kth(df: DataFrame, value_col: str, targets: dict, group_cols: Sequence[str] = (), *,
               payload: Sequence[str] = (), init: dict | None = None, buckets: int = BUCKETS,
               finish_rows: int = FINISH_ROWS, accuracy: int = 10_000) -> dict:
    """Exact k-th smallest (0-based) ``value_col`` for each target.

    ``targets``: {target_id: (group_tuple, k)}.  Rows with a null/NaN value
    are ignored.  Returns {target_id: value}; with ``payload`` columns
    {target_id: (value, *payload)}, ties on value ordered by the payload
    (used for exact cuts over (hash, key) orders).  Targets beyond the
    group size map to None.  ``init`` ({group_tuple: (n, min, max)}, e.g.
    from :func:`group_stats`) replaces the first counting pass.

    Targets that share a search interval (all targets of a group in the
    first round) share one tag per row, so the work per round grows with
    the number of distinct intervals, not of targets.
    """
    group_cols, payload = list(group_cols), list(payload)
    base = (df.select(*group_cols, F.col(value_col).cast("double").alias("_v"), *payload)
            .filter(F.col("_v").isNotNull() & ~F.isnan("_v")))
    state = {t: {"g": tuple(g), "k": int(k), "lo": None, "hi": None, "n": None,
                 "mode": "width"} for t, (g, k) in targets.items()}
    for s in state.values():
        if init is not None:
            n, lo, hi = init.get(s["g"], (0, None, None))
            s.update(n=n, lo=lo, hi=hi)
    done: dict = {t: None for t, s in state.items() if s["k"] < 0}

    def ivkey(s):
        return (s["g"], s["lo"], s["hi"], s["mode"])

    for _round in range(200):
        live = {t: s for t, s in state.items() if t not in done}
        if not live:
            break
        ivs: dict = {}
        for s in live.values():
            ivs.setdefault(ivkey(s), f"i{len(ivs)}")

        def inside(key):
            cond = _group_match(group_cols, key[0])
            if key[1] is not None:
                cond = cond & (F.col("_v") >= F.lit(key[1])) & (F.col("_v") <= F.lit(key[2]))
            return cond
        # live intervals of one group never overlap (they are disjoint buckets
        # of earlier rounds), so a row belongs to at most one: a CASE chain
        tag = None
        for key, iid in ivs.items():
            tag = F.when(inside(key), F.lit(iid)) if tag is None else \
                tag.when(inside(key), F.lit(iid))
        hit = base.select("_v", *payload, tag.alias("_t")).filter(F.col("_t").isNotNull())
        if any(s["n"] is None for s in live.values()):  # first pass: count, min, max
            first = {r["_t"]: r for r in hit.groupBy("_t").agg(
                F.count(F.lit(1)).alias("n"), F.min("_v").alias("mn"),
                F.max("_v").alias("mx")).collect()}
            for s in live.values():
                r = first.get(ivs[ivkey(s)])
                s.update(n=r["n"] if r else 0, lo=r["mn"] if r else None,
                         hi=r["mx"] if r else None)
            continue  # interval keys changed; re-tag with the tight bounds
        small = set()
        for t, s in live.items():
            if s["k"] >= s["n"]:
                done[t] = None
            elif s["lo"] == s["hi"] and not payload:
                done[t] = s["lo"]
            elif s["n"] <= finish_rows:
                small.add(ivs[ivkey(s)])
            elif s["lo"] == s["hi"]:
                raise ValueError(f"more than {finish_rows} rows tie on {value_col}={s['lo']}; "
                                 "add a unique tiebreak to the order")
        if small:
            pairs = (hit.filter(F.col("_t").isin(sorted(small))).groupBy("_t", "_v", *payload)
                     .agg(F.count(F.lit(1)).alias("_c")).collect())
            by_iv: dict = {}
            for r in pairs:
                by_iv.setdefault(r["_t"], []).append(r)
            for iid in by_iv:
                by_iv[iid].sort(key=lambda r: tuple(
                    (x is None, x) for x in [r["_v"], *[r[p] for p in payload]]))
            for t, s in live.items():
                iid = ivs[ivkey(s)]
                if t in done or iid not in small:
                    continue
                k = s["k"]
                for r in by_iv.get(iid, []):
                    if k < r["_c"]:
                        done[t] = (r["_v"], *[r[p] for p in payload]) if payload else r["_v"]
                        break
                    k -= r["_c"]
        live = {t: s for t, s in live.items() if t not in done}
        if not live:
            break
        big = {ivkey(s): ivs[ivkey(s)] for s in live.values()}
        wide = hit.filter(F.col("_t").isin(sorted(big.values())))
        qkeys = [key for key in big if key[3] == "quantile"]
        if qkeys:
            probs = [i / buckets for i in range(1, buckets)]
            bounds = {r["_t"]: list(r["_b"]) for r in wide.filter(
                F.col("_t").isin([big[k] for k in qkeys])).groupBy("_t").agg(
                F.array_sort(F.array_distinct(F.percentile_approx("_v", probs, accuracy)))
                .alias("_b")).collect()}
            bnd = wide.sparkSession.createDataFrame(
                [(t, b) for t, b in bounds.items()], "_t string, _b array<double>")
            # quantile-mode intervals x B doubles: bounded by construction
            wide = with_bucket(wide.join(F.broadcast(bnd), "_t", "left"), "_v", "_b", buckets,
                               "_qbk")
        bk = None
        for key, iid in big.items():
            e = F.col("_qbk") if key[3] == "quantile" else _width_bucket(
                F.col("_v"), key[1], key[2], buckets)
            bk = F.when(F.col("_t") == iid, e) if bk is None else bk.when(F.col("_t") == iid, e)
        stats = (wide.withColumn("_bk", bk).groupBy("_t", "_bk")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("mn"),
                      F.max("_v").alias("mx")).collect())
        per_iv: dict = {}
        for r in stats:
            per_iv.setdefault(r["_t"], []).append(r)
        for iid in per_iv:
            per_iv[iid].sort(key=lambda r: r["_bk"])
        for t, s in live.items():
            k = s["k"]
            for r in per_iv[ivs[ivkey(s)]]:
                if k < r["n"]:
                    mode = "quantile" if 2 * r["n"] > s["n"] else "width"
                    s.update(k=k, n=r["n"], lo=r["mn"], hi=r["mx"], mode=mode)
                    break
                k -= r["n"]
    else:
        raise RuntimeError("selection did not converge")
    return done


def group_stats(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                extra: Sequence[Column] = ()) -> dict:
    """{group_tuple: Row(n, mn, mx, *extra)} over non-missing values, one aggregate."""
    v = F.col(value_col).cast("double")
    rows = (df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*group_cols)
            .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("mn"), F.max(v).alias("mx"),
                 *extra).collect())
    return {tuple(r[g] for g in group_cols): r for r in rows}


def group_sizes(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> dict:
    """Non-missing rows per group (one aggregate, one row per group)."""
    return {g: r["n"] for g, r in group_stats(df, value_col, group_cols).items()}
