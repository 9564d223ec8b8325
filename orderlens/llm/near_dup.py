"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, stars.

A document's set holds its distinct 5-word shingles (64-bit hashes).  Hashes
fall into 128 bins by their top bits and the least hash of a bin is its
minimum; an empty bin copies the minimum of the first non-empty bin in its own
fixed random probe order.  Bands of five bins give 25 bucket keys.  Equal sets
are one class before any bucket is built, so a large group of copies is one
bucket member.  Inside a bucket every member is paired with one centre only (a
star), so candidate pairs never exceed memberships.  Pairs are confirmed on the
full sets.  Buckets that still span several components get further stars with
other centres, only for members outside the centre's component, in
``STAR_ROUNDS`` rounds.  What is then left of the open buckets is compared
exactly, pair by pair across components, in blocks of ``BLOCK`` members;
buckets with the same members are compared once.

A pair at the threshold (``link`` percent) misses all 25 buckets with probability
4e-7 at 85 and 5e-5 at 80.

Defined results: null, empty and white-space texts have an empty set and link
with nothing, like null doc_ids (component null); repeated rows of a doc_id and
text give one row; different texts under one doc_id give a row each and share
the component of that id; ties go to the smaller doc_id; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import broadcast_checked, connected_components, map_text, written

SHINGLE = 5
BINS = 128
BANDS, ROWS = 25, 5
LINK = 85              # least 100 * intersection / union
STAR_ROUNDS = 2        # further star rounds before open buckets are compared exactly
BLOCK = 512            # members of an open bucket that one side of a task holds
MAX_BROADCAST = 2_000_000   # ids (8 bytes) that may be broadcast to select texts

_U = np.uint64
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHash(dict):
    def __missing__(self, w):
        h = xxhash.xxh3_64_intdigest(w)
        if len(self) < 100_000 and len(w) <= 64:
            self[w] = h
        return h


def shingle_set(text: str | None, known: _WordHash, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; bytes.lower/split are ASCII-only."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=n)
    take = min(n, size)
    total = np.full(n - take + 1, (take * 0x9E3779B97F4A7C15) & _MASK, dtype=np.uint64)
    for k in range(take):
        total = total * _U(0x100000001B3) + h[k:n - take + 1 + k]
        total ^= total >> _U(29)
    return np.unique(_mix(total))


def _probes(bins: int, tries: int = 64) -> np.ndarray:
    """probe[t, b]: the bin that empty bin b looks at in try t (fixed pseudo-random values)."""
    t, b = np.meshgrid(np.arange(tries, dtype=np.uint64), np.arange(bins, dtype=np.uint64), indexing="ij")
    return (_mix(t * _U(1_000_003) + b * _U(0x9E3779B97F4A7C15) + _U(1)) % _U(bins)).astype(np.int64)


_STARTS = (np.arange(BINS, dtype=np.uint64) << _U(57))
_PROBE = _probes(BINS)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The 128 bin minima after densification (``hashes`` sorted, not empty)."""
    at = np.searchsorted(hashes, _STARTS)
    edge = np.append(at[1:], len(hashes))
    full = at < edge
    out = hashes[np.minimum(at, len(hashes) - 1)]
    if not full.all():
        donor = out.copy()
        empty = np.flatnonzero(~full)
        for row in _PROBE:
            pick = row[empty]
            ok = full[pick]
            out[empty[ok]] = donor[pick[ok]]
            empty = empty[~ok]
            if not len(empty):
                break
        for b in empty:                       # later tries, one by one, on the same kind of order
            t = len(_PROBE)
            while True:
                p = xxhash.xxh3_64_intdigest(b"%d/%d" % (b, t)) % BINS
                if full[p]:
                    out[b] = donor[p]
                    break
                t += 1
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig[:BANDS * ROWS].reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = _mix(key * _U(0x100000001B3) + rows[:, r])
    return key.view(np.int64)


def sketch(documents: DataFrame) -> DataFrame:
    """(doc_id, tkey, n_shingles, set_id, bands) per document; set_id is null for an empty set."""
    def start():
        known = _WordHash()

        def f(texts):
            n, ids, keys = [], [], []
            for t in texts:
                s = shingle_set(t, known)
                n.append(len(s))
                ids.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(band_keys(signature(s)) if len(s) else [])
            return [n, ids, keys]
        return f
    keyed = documents.select("doc_id", F.xxhash64("text").alias("tkey"), "text")
    return map_text(keyed, ["doc_id", "tkey"], "text", start, [
        ("n_shingles", "long"), ("set_id", "binary"), ("bands", "array<long>")])


def full_sets(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, s): the whole shingle set of the wanted documents."""
    def start():
        known = _WordHash()
        return lambda texts: [[shingle_set(t, known).view(np.int64) for t in texts]]
    wanted = documents.select("doc_id", "text").join(broadcast_checked(ids, MAX_BROADCAST), "doc_id", "left_semi")
    return map_text(wanted, ["doc_id"], "text", start, [("s", "array<long>")])


def _confirm(pairs: DataFrame, sets: DataFrame, link: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    sa = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
    sb = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(sa, "a").join(sb, "b")
            .where(100 * both >= link * (F.size("sa") + F.size("sb") - both))
            .select("a", "b", "x", "y").dropDuplicates(["a", "b"]))


def _block_links(f: pd.DataFrame, other: np.ndarray | None, link: int) -> pd.DataFrame:
    """Links (a, b) that join components inside one block, or between it and the rows of ``other``."""
    ids, sets = f["doc_id"].to_numpy(), f["s"].to_numpy()
    _, lab, share = np.unique(f["comp"].to_numpy(), return_inverse=True, return_counts=True)
    size = np.fromiter(map(len, sets), dtype=np.int64, count=len(f))
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    names, at = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(names), dtype=np.int64)
    # members of small components first: those of the largest then have few to meet
    order = np.argsort(share[lab], kind="stable")
    waiting = np.ones(len(f), dtype=bool) if other is None else other
    found = []
    for i in order if other is None else order[~other[order]]:
        if other is None:
            waiting[i] = False
        near = 100 * np.minimum(size, size[i]) >= link * np.maximum(size, size[i])
        if not (cand := waiting & (lab != lab[i]) & near).any():
            continue
        mine = at[start[i]:start[i] + size[i]]
        mark[mine] = 1
        both = np.add.reduceat(mark[at], start)
        mark[mine] = 0
        for j in np.flatnonzero(cand & (100 * both >= link * (size + size[i] - both))):
            if lab[j] != lab[i]:
                found.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
                lab[lab == lab[j]] = lab[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _rest(members: DataFrame, sets: DataFrame, link: int, block: int) -> DataFrame:
    """(a, b): links across the components of every open bucket, all its pairs compared."""
    def h(seed):        # 44 bits, so that their sums stay in range
        return F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 20)).alias(f"h{seed}")

    # the first star has tried the one pair of a bucket of two; equal buckets are compared once
    size = members.groupBy("band", "key").agg(F.count("*").alias("k"), h(1), h(2)).where("k > 2")
    size = written(size.groupBy("k", "h1", "h2").agg(F.min(F.struct("band", "key")).alias("at"))
                   .select("at.*", F.ceil(F.col("k") / block).cast("int").alias("nb")), "near-rest")
    rows = (members.select("band", "key", "doc_id", "comp").join(size, ["band", "key"])
            .withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("nb")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .select("band", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                    "own", "doc_id", "comp").join(sets, "doc_id"))

    def compare(key, f):
        f = f.reset_index(drop=True)
        return _block_links(f, None if key[2] == key[3] else (f["own"] == key[3]).to_numpy(), link)

    return rows.groupBy("band", "key", "lo", "hi").applyInPandas(compare, "a long, b long").distinct()


def _components(documents: DataFrame, link: int, block: int = BLOCK) -> DataFrame:
    """(doc_id, tkey, n_shingles, component_id) per document."""
    sk = written(sketch(documents), "near-sketch")
    live = sk.where("set_id is not null and doc_id is not null")
    classes = written(live.groupBy("set_id").agg(F.min("doc_id").alias("rep")), "near-classes")
    reps = live.join(classes, "set_id").where("doc_id = rep").dropDuplicates(["rep", "set_id"])
    buckets = written(reps.select("doc_id", F.col("n_shingles").alias("n"),
                                  F.posexplode("bands").alias("band", "key")), "near-buckets")
    shared = written(buckets.groupBy("band", "key").agg(
        F.min(F.struct("doc_id", "n", F.col("doc_id").alias("comp"))).alias("c"), F.count("*").alias("k"))
        .where("k > 1").select("band", "key", "c"), "near-shared")
    # at first every document is a component of its own
    members = written(buckets.join(shared, ["band", "key"]).withColumn("comp", F.col("doc_id")), "near-members")
    sets = written(full_sets(documents, members.select("doc_id").distinct())
                   .dropDuplicates(["doc_id", "s"]), "near-sets")

    near = 100 * F.least("n", "nb") >= link * F.greatest("n", "nb")   # length bound

    def pairs_of(frame: DataFrame) -> DataFrame:
        """Star edges (a, b) with the components (x, y) they would join."""
        return (frame.where("doc_id <> c.doc_id")
                .select("doc_id", "n", F.col("c.doc_id").alias("cb"), F.col("c.n").alias("nb"),
                        F.col("comp").alias("x"), F.col("c.comp").alias("y")).where(near)
                .select(F.greatest("doc_id", "cb").alias("a"), F.least("doc_id", "cb").alias("b"), "x", "y")
                .dropDuplicates(["a", "b"]))

    tried = written(pairs_of(members), "near-pairs")
    links = fresh = written(_confirm(tried, sets, link), "near-links")
    for r in range(1, STAR_ROUNDS + 2):
        # only the new links can join components; closed buckets (one component) never open again
        comp = written(connected_components(fresh.select(F.col("x").alias("a"), F.col("y").alias("b")),
                                            f"near-cc{r}"), f"near-comp{r}")
        now = members.join(comp.withColumnRenamed("node", "comp"), "comp", "left").select(
            "band", "key", "doc_id", "n", F.coalesce("component", "comp").alias("comp"))
        now = written(now, f"near-now{r}")
        if r > STAR_ROUNDS:     # the stars are done: the members of the open buckets meet each other
            open_ = written(now.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                            .where("lo <> hi").select("band", "key"), "near-open-rest")
            if not open_.isEmpty():
                members = written(now.join(open_, ["band", "key"]), "near-members-rest")
                links = links.select("a", "b").unionByName(
                    written(_rest(members, sets, link, block), "near-rest-links"))
            break
        centre = F.struct(F.xxhash64("doc_id", "band", F.lit(r)).alias("h"), "doc_id", "n", "comp")
        open_ = written(now.groupBy("band", "key").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(centre).alias("c"))
            .where("lo <> hi").select("band", "key", "c"), f"near-open{r}")
        if open_.isEmpty():
            break
        members = written(now.join(open_, ["band", "key"]), f"near-members{r}")
        step = pairs_of(members.where("comp <> c.comp"))
        step = written(step.join(tried.select("a", "b"), ["a", "b"], "left_anti"), f"near-pairs{r}")
        fresh = written(_confirm(step, sets, link), f"near-links{r}")
        tried, links = tried.unionByName(step), links.unionByName(fresh)
    comp = connected_components(links, "near-final")
    rep = (classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
           .select("set_id", F.coalesce("component", "rep").alias("class_id")))
    rep = written(rep, "near-ids")
    out = sk.select("doc_id", "tkey", "n_shingles", "set_id").join(rep, "set_id", "left")
    return (out.select("doc_id", "tkey", "n_shingles",
                       F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("component_id"))
            .distinct())


def components(documents: DataFrame, link: int = LINK) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document."""
    return _components(documents, link).drop("tkey").distinct()


def report(documents: DataFrame, link: int = LINK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept)."""
    return components(documents, link).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(documents: DataFrame, link: int = LINK) -> DataFrame:
    """The rows that ``report`` marks kept, all columns: one document of each group, the one with the
    smallest doc_id; repeated rows of a doc_id and text give one, rows without doc_id all stay."""
    got = written(_components(documents, link).where("doc_id is not null"), "near-report")
    gone = written(got.where("doc_id <> component_id").select("doc_id", F.col("tkey").alias("_near_tkey")).distinct(),
                   "near-gone")
    keyed = documents.withColumn("_near_tkey", F.xxhash64("text"))
    left = keyed.join(broadcast_checked(gone, MAX_BROADCAST // 2), ["doc_id", "_near_tkey"], "left_anti")
    # rows that repeat a doc_id and text are repeated rows: one stays (the shuffle runs only if there are any)
    total, ids = documents.where("doc_id is not null").count(), got.select("doc_id", "tkey").distinct().count()
    if total > ids:
        left = (left.where("doc_id is not null").dropDuplicates(["doc_id", "_near_tkey"])
                .unionByName(left.where("doc_id is null")))
    return left.select(*documents.columns)
