"""Embedding near-duplicates with a pivot-permutation index.

Every vector is described by its nearest pivots in order.  An inverted list
per pivot holds the vectors that name it; two vectors are candidates when they
share at least ``MIN_SHARED`` pivots, and every candidate is verified by the
cosine in double precision.  A pair that meets in several lists is counted in
the list of its smallest shared pivot only.

Equal vectors are one list entry with a multiplicity.  Long lists are cut into
blocks that are compared pairwise, so no task holds more than two blocks, and a
task returns one row per entry (its links and the smallest id of its local
component), never pairs.  The number of pivots grows with the square root of
the number of vectors; pivots come from the table by hash order, at most
``MAX_PIVOTS``, and every vector is indexed.  Nearness to pivots is measured
from the mean of the pivot candidates, so vectors that share a common direction
(text embeddings do) spread over the lists like any others; links are verified
on the vectors as they are.  No two pivots have a cosine of ``APART`` or more
seen from there, so a dense group holds few pivots, its members name the same
ones, and recall does not depend on the group's share of the table; where that
leaves less than ``4 * NEAREST`` pivots the bound is raised step by step.  Up to
``MIN_PIVOTS`` vectors, each names all pivots.

Defined results: null, empty and all-zero vectors, vectors with null or
non-finite components or another length than most vectors have, and rows with
a null vec_id link with nothing (component = own id, kept); repeated rows of
one vec_id and vector count once and give one row; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import connected_components, written

COSINE = 0.9
NEAREST = 12           # pivots that describe a vector
MIN_SHARED = 2
PIVOTS_PER_ROOT = 4    # pivots = this times the square root of the vectors
MIN_PIVOTS, MAX_PIVOTS = 48, 4096
APART = (0.5, 0.6, 0.7, 0.8)   # pivots have smaller cosines to each other: the first that leaves enough of them
BLOCK = 1024           # entries of an inverted list that one side of a task holds


def usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(vectors) -> np.ndarray:
    x = np.asarray(list(vectors), dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)        # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _from(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Unit directions of unit vectors seen from ``centre`` (a vector that lies there has none: zeros)."""
    y = x - centre
    return y / np.maximum(np.sqrt((y * y).sum(axis=1, keepdims=True)), 1e-12)


def choose_pivots(x: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
    """(pivots, centre) out of unit vectors in hash order."""
    centre = x.mean(axis=0, keepdims=True) if len(x) > 2 else np.zeros((1, x.shape[1]))
    y = _from(x, centre)
    for cosine in APART:
        pivots = apart(y, cosine)
        if len(pivots) >= enough:
            break
    return pivots, centre


def apart(x: np.ndarray, cosine: float) -> np.ndarray:
    """The unit vectors, in order, whose cosine to every one taken before is below ``cosine``."""
    taken = np.empty_like(x)
    n = 0
    for v in x:
        if not n or (taken[:n] @ v).max() < cosine:
            taken[n] = v
            n += 1
    return taken[:n]


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, m: int) -> np.ndarray:
    """The m nearest pivots of each unit vector, nearest first (ties: lower number)."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :m].astype(np.int32)


def _list_block(pivot: int, a: pd.DataFrame, b: pd.DataFrame | None, cosine: float, min_shared: int):
    """Links between two blocks of one list (or inside one): per entry (links, local component)."""
    rows = a if b is None else pd.concat([a, b], ignore_index=True)
    x, near = _unit(rows["v"]), np.stack(rows["near"].to_numpy()).astype(np.int64)
    ids, mult = rows["rep"].to_numpy(), rows["mult"].to_numpy()
    names, local = np.unique(near, return_inverse=True)
    member = np.zeros((len(rows), len(names)), dtype=np.float32)
    member[np.arange(len(rows))[:, None], local.reshape(near.shape)] = 1
    na = len(a)
    links, lab = np.zeros(len(rows), dtype=np.int64), ids.copy()
    found = []
    for s in range(0, na, 256):
        e = min(na, s + 256)
        left = np.arange(s, e)
        right = np.arange(len(rows)) if b is None else np.arange(na, len(rows))
        shared = member[left] @ member[right].T
        cand = shared >= min_shared
        if b is None:
            cand &= right[None, :] > left[:, None]
        if not cand.any():
            continue
        cand &= (x[left] @ x[right].T) >= cosine
        i, j = np.nonzero(cand)
        if not len(i):
            continue
        i, j = left[i], right[j]
        for c in range(0, len(i), 100_000):          # smallest shared pivot names the pair's list
            ii, jj = i[c:c + 100_000], j[c:c + 100_000]
            same = (near[ii][:, :, None] == near[jj][:, None, :]).any(axis=2)
            least = np.where(same, near[ii], 1 << 30).min(axis=1) == pivot
            found.append((ii[least], jj[least]))
    if found:
        i, j = (np.concatenate(z) for z in zip(*found))
        links += np.bincount(i, mult[j], len(rows)).astype(np.int64)
        links += np.bincount(j, mult[i], len(rows)).astype(np.int64)
        while True:
            before = lab.copy()
            low = np.minimum(lab[i], lab[j])
            np.minimum.at(lab, i, low)
            np.minimum.at(lab, j, low)
            if (before == lab).all():
                break
    hit = links > 0
    return pd.DataFrame({"rep": ids[hit], "links": links[hit], "root": lab[hit]})


def index(reps: DataFrame, pivots: np.ndarray, centre: np.ndarray, nearest: int = NEAREST) -> DataFrame:
    """Inverted lists: (pivot, rep, mult, near, v), a row per vector and named pivot."""
    def run(frames):
        for f in frames:
            if len(f):
                near = nearest_pivots(_from(_unit(f["v"]), centre), pivots, nearest)
                k = near.shape[1]
                at = np.repeat(np.arange(len(f)), k)
                yield pd.DataFrame({"pivot": near.ravel(), "rep": f["rep"].to_numpy()[at],
                                    "mult": f["mult"].to_numpy()[at], "near": [near[i] for i in at],
                                    "v": f["v"].to_numpy()[at]})
    return reps.mapInPandas(run, f"pivot int, rep long, mult long, near array<int>, v {reps.schema['v'].dataType.simpleString()}")


def components(embeddings: DataFrame, cosine: float = COSINE, nearest: int = NEAREST,
               min_shared: int = MIN_SHARED, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id) per distinct (vec_id, vector)."""
    kind = embeddings.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"     # no component loses digits
    rows = embeddings.select("vec_id", F.col("embedding").cast(kind).alias("v")).distinct()
    rows = written(rows.withColumn("ok", usable(F.col("v")) & F.col("vec_id").isNotNull()), "embed-rows")
    sizes = rows.where("ok").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    top = sizes.first()
    dim = top["d"] if top else 0
    good = rows.where(F.col("ok") & (F.size("v") == dim)).select("vec_id", "v")
    reps = written(good.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("mult")),
                   "embed-reps")
    n = reps.count()
    k = min(n, max(MIN_PIVOTS, min(MAX_PIVOTS, math.ceil(PIVOTS_PER_ROOT * math.sqrt(n)))))
    # at most MAX_PIVOTS rows reach the driver
    chosen = [r["v"] for r in reps.orderBy(F.xxhash64("rep"), "rep").limit(k).collect()] if k else []
    pivots, centre = choose_pivots(_unit(chosen), 4 * nearest) if chosen else (np.zeros((0, 1)), np.zeros((1, 1)))
    named = len(pivots) if n <= MIN_PIVOTS else min(nearest, max(2, math.ceil(len(pivots) / 4)))
    shared = max(1, min(min_shared, named // 4))
    lists = written(index(reps, pivots, centre, named), "embed-lists")

    # a list of s entries has ceil(s / block) blocks; an entry meets every block of its list once
    length = lists.groupBy("pivot").agg(F.ceil(F.count("*") / block).cast("int").alias("nb"))
    own = F.pmod(F.xxhash64("rep", "pivot"), F.col("nb")).cast("int")
    tasks = (lists.join(F.broadcast(length), "pivot")      # at most MAX_PIVOTS rows
             .withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))
    columns = ["pivot", "lo", "hi", "own", "rep", "mult", "near", "v"]

    def compare(key, f):
        pivot, lo, hi = key
        if lo == hi:
            return _list_block(int(pivot), f.reset_index(drop=True), None, cosine, shared)
        side = f["own"] == lo
        return _list_block(int(pivot), f[side], f[~side], cosine, shared)

    part = written(tasks.select(*columns).groupBy("pivot", "lo", "hi")
                   .applyInPandas(compare, "rep long, links long, root long"), "embed-links")
    links = part.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = connected_components(part.select(F.col("rep").alias("a"), F.col("root").alias("b")), "embed-cc")
    per = written(reps.join(links, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                  .select("v", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                          F.coalesce("component", "rep").alias("component_id")), "embed-per")
    joined = good.join(per, "v").select("vec_id", "n_links", "component_id")
    rest = rows.where(~(F.col("ok") & (F.size("v") == dim))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(rest)


def report(embeddings: DataFrame, **kw) -> DataFrame:
    """(vec_id, n_links, component_id, kept)."""
    return components(embeddings, **kw).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
