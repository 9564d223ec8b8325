"""Repeated-substring removal by column-wise multi-document suffix construction.

A byte goes when a string of ``length`` bytes that covers it also starts
earlier (smaller doc_id, or earlier in the same document).

1. Equal documents are one class; later copies go whole.
2. In every window of ``length`` bytes one anchor is chosen by content, the
   smallest hash among its 32-byte strings.  Equal windows choose the same
   anchor, so only anchors whose string occurs twice can hold repeats, and an
   anchor speaks for the run of windows that chose it.
3. The bytes around each repeated anchor are a short document of a collection.
   Per partition (by anchor hash) the collection's suffixes are built column by
   column from the right: each round puts one symbol in front of every
   document, and a stable sort by that symbol turns the order of the last round
   into the order of this one - the symbols in that order are the column's part
   of the collection's Burrows-Wheeler transform.  Windows are equal exactly
   where neighbours in the order have a common prefix of ``length``; all but the
   earliest of such a run are repeats.
4. Anchors of more than ``HOT`` members do not meet in one task: equal contexts
   are folded by aggregation, and the windows of what is left are keyed by
   their own 128-bit hash.  Both are combined map-side and joined by skew joins.

The sorted columns live in Spark's shuffled partitions; every intermediate
table is written to the shared folder.

Defined results: null and empty texts have no bytes; texts shorter than
``length`` lose nothing; rows that repeat a doc_id and text are one document;
different texts under one doc_id are ordered by their hash after that id; null
doc_ids are not compared and lose nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import broadcast_checked, small_batches, tidy, written

LENGTH = 100
GRAM = 32
HOT = 40
SEGMENT = 1 << 22           # bytes of a very long document handled at a time
TASK_ROWS = 40_000          # anchors (168 bytes around each) that one task of the column-wise order holds
MAX_BROADCAST = 2_000_000   # anchor hashes or ids (8 bytes) that may be broadcast

_U = np.uint64
_TABLE = np.random.default_rng(20_240_607).integers(1, 1 << 63, 256, dtype=np.uint64)
_POS = _U((1 << 24) - 1)


def gram_hashes(b: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of every ``gram``-byte string (a power of two), by doubling."""
    h, width = _TABLE[b], 1
    while width < gram:
        h = h[:-width] * _U(0x9E3779B97F4A7C15) + (h[width:] ^ (h[width:] >> _U(31)))
        h ^= h >> _U(29)
        width *= 2
    return h


def anchors(b: np.ndarray, length: int = LENGTH, gram: int = GRAM, segment: int = SEGMENT):
    """(hash, position, first window, last window) of each anchor: windows [first, last] chose it."""
    n = len(b) - length + 1
    if n <= 0:
        return None
    out = []
    for base in range(0, n, segment):                 # window starts base .. stop - 1
        stop = min(n, base + segment)
        h = gram_hashes(b[base:stop + length - 1], gram)
        key = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
        span, width, m = length - gram + 1, 1, key
        while width * 2 <= span:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        if width < span:
            m = np.minimum(m[:len(m) - (span - width)], m[span - width:])
        pos = (m & _POS).astype(np.int64)
        cut = np.flatnonzero(np.diff(pos)) + 1
        first = np.concatenate(([0], cut))
        last = np.concatenate((cut, [len(pos)])) - 1
        out.append((h[pos[first]].view(np.int64), pos[first] + base, first + base, last + base))
    return tuple(np.concatenate(x) for x in zip(*out)) if len(out) > 1 else out[0]


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8"), dtype=np.uint8)


def anchor_counts(documents: DataFrame, length: int, segment: int) -> DataFrame:
    """(h, n): anchor hashes that occur at least twice."""
    def run(batches):
        for b in batches:
            found = [a[0] for t in b.column(0).to_pylist() if t and (a := anchors(_bytes(t), length, segment=segment))]
            if found:
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])
    rows = documents.select("text").mapInArrow(tidy(run), "h long, n long")
    return written(rows.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1"), "suffix-repeated")


def anchor_rows(documents: DataFrame, length: int, segment: int) -> DataFrame:
    """(h, doc_id, tkey, a, lo, hi) for every anchor of every document."""
    def run(batches):
        for b in batches:
            ids, keys = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            rows = [(i, a) for i, t in enumerate(b.column(2).to_pylist()) if t and (a := anchors(_bytes(t), length, segment=segment))]
            if rows:
                at = np.repeat([i for i, _ in rows], [len(a[0]) for _, a in rows])
                h, a, lo, hi = (np.concatenate([x[k] for _, x in rows]) for k in range(4))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(ids[at]), pa.array(keys[at]), pa.array(a, pa.int32()),
                     pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], ["h", "doc_id", "tkey", "a", "lo", "hi"])
    return documents.select("doc_id", "tkey", "text").mapInArrow(
        tidy(run), "h long, doc_id long, tkey long, a int, lo int, hi int")


def contexts(documents: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h, doc_id, tkey, a, lo, hi, ctx): the bytes [lo, hi + length) around wanted anchors."""
    cols = ["h", "a", "lo", "hi"]
    per = wanted.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct(*cols)).alias("w"))
    per = written(per.select("doc_id", "tkey", *[F.col(f"w.{c}").alias(c) for c in cols]), "suffix-wanted")
    ids = broadcast_checked(per.select("doc_id", "tkey"), MAX_BROADCAST)
    docs = documents.select("doc_id", "tkey", "text").join(ids, ["doc_id", "tkey"], "left_semi")

    def run(batches):
        for b in batches:
            get = dict(zip(b.schema.names, b.columns))
            per_doc = get["a"].value_lengths().to_numpy()
            flat = {c: get[c].flatten() for c in cols}
            cuts = list(zip(flat["lo"].to_pylist(), (flat["hi"].to_numpy() + length).tolist()))
            ctx, at = [], 0
            for t, k in zip(get["text"].to_pylist(), per_doc.tolist()):
                raw = t.encode("utf-8")
                ctx += [raw[s:e] for s, e in cuts[at:at + k]]
                at += k
            ids = {c: pa.array(np.repeat(get[c].to_numpy(zero_copy_only=False), per_doc)) for c in ("doc_id", "tkey")}
            yield pa.RecordBatch.from_arrays(
                [flat["h"], ids["doc_id"], ids["tkey"], flat["a"], flat["lo"], flat["hi"], pa.array(ctx, pa.binary())],
                ["h", "doc_id", "tkey", "a", "lo", "hi", "ctx"])
    return docs.join(per, ["doc_id", "tkey"]).select("doc_id", "tkey", "text", *cols).mapInArrow(
        tidy(run), "h long, doc_id long, tkey long, a int, lo int, hi int, ctx binary")


def column_repeats(rank: np.ndarray, left: np.ndarray, count: np.ndarray, ctx: list, length: int,
                   gram: int = GRAM) -> np.ndarray:
    """repeat[x, i]: the window that starts x bytes before member i's anchor also starts earlier.

    ``rank`` orders members by (document, position), ``left`` is the distance from
    the first window to the anchor, ``count`` the number of windows, ``ctx`` the bytes.
    """
    reach = length - gram                       # windows start 0 .. reach bytes before the anchor
    width = reach + length
    m = len(ctx)
    grid = np.zeros((width, m), dtype=np.uint8)   # one row per column of the collection
    lens = np.fromiter(map(len, ctx), dtype=np.int64, count=m)
    flat = np.frombuffer(b"".join(ctx), dtype=np.uint8)
    off = np.concatenate(([0], np.cumsum(lens)[:-1]))
    who = np.repeat(np.arange(m), lens)
    grid[np.arange(len(flat)) - off[who] + (reach - left)[who], who] = flat
    order = np.arange(m)
    repeat = np.zeros((reach + 1, m), dtype=bool)
    never = np.int64(m)
    for c in range(width - 1, -1, -1):
        # insert this column's symbol in front of every document
        order = order[np.argsort(grid[c][order], kind="stable")]
        x = reach - c
        if x < 0:
            continue
        valid = (left >= x) & (left - count < x)        # windows that chose this anchor
        own = order[valid[order]]
        if len(own) < 2:
            continue
        bwt = grid[c:c + length, own]
        new = np.concatenate(([True], (bwt[:, 1:] != bwt[:, :-1]).any(axis=0)))
        starts = np.flatnonzero(new)
        first = np.minimum.reduceat(np.append(rank[own], never)[:len(own)], starts)
        repeat[x, own] = rank[own] > first[np.cumsum(new) - 1]
    return repeat


def _runs(repeat: np.ndarray, a: np.ndarray, length: int):
    """(member, start, end) byte spans of maximal runs of repeated windows."""
    by_start = repeat[::-1].T                    # column y: window starting reach - y bytes before
    reach = repeat.shape[0] - 1
    edge = np.diff(np.pad(by_start.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    who, s = np.nonzero(edge == 1)
    _, e = np.nonzero(edge == -1)
    return who, a[who] - reach + s, a[who] - reach + e - 1 + length


def cold_spans(ctx: DataFrame, length: int, parts: int) -> DataFrame:
    """(doc_id, tkey, s, e): repeated byte spans found inside each anchor group of up to HOT members."""
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        d, k, a, lo, hi = (t.column(c).to_numpy() for c in ("doc_id", "tkey", "a", "lo", "hi"))
        order = np.lexsort((a, k, d))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        rep = column_repeats(rank, (a - lo).astype(np.int64), (hi - lo + 1).astype(np.int64),
                             t.column("ctx").to_pylist(), length)
        who, s, e = _runs(rep, a.astype(np.int64), length)
        yield pa.RecordBatch.from_arrays([pa.array(d[who]), pa.array(k[who]), pa.array(s, pa.int32()),
                                          pa.array(e, pa.int32())], ["doc_id", "tkey", "s", "e"])
    return (ctx.repartition(parts, "h").select("doc_id", "tkey", "a", "lo", "hi", "ctx")
            .mapInArrow(tidy(run), "doc_id long, tkey long, s int, e int"))


def hot_spans(ctx: DataFrame, length: int) -> DataFrame:
    """The same for groups of more than HOT members, by aggregation and skew joins."""
    def key(v, name):     # two hashes with independent seeds: 128 bits
        return [F.xxhash64(F.lit(k), v).alias(f"{name}{k}") for k in (1, 2)]

    who = F.struct("doc_id", "tkey", "a")
    shape = F.struct("ctx", F.col("a") - F.col("lo"), F.col("hi") - F.col("lo"))
    rows = ctx.select("*", *key(shape, "c"))
    first = written(rows.groupBy("c1", "c2").agg(F.min(who).alias("first")), "suffix-context")
    rows = written(rows.join(first, ["c1", "c2"]).withColumn("again", who > F.col("first"))
                   .select("doc_id", "tkey", "a", "lo", "hi", "again", F.when(~F.col("again"), F.col("ctx")).alias("ctx")),
                   "suffix-folded")
    whole = rows.where("again").select("doc_id", "tkey", F.col("lo").alias("s"), (F.col("hi") + length).alias("e"))
    win = (rows.where("not again").select("doc_id", "tkey", "a", "ctx",
                                          F.posexplode(F.sequence("lo", "hi")).alias("k", "s")))
    part = F.struct(F.substring(F.col("ctx"), F.col("k") + 1, F.lit(length)), F.col("a") - F.col("s"))
    win = win.select("doc_id", "tkey", "s", *key(part, "w"))
    at = F.struct("doc_id", "tkey", "s")
    least = written(win.groupBy("w1", "w2").agg(F.min(at).alias("first"), F.count("*").alias("c"))
                    .where("c > 1").select("w1", "w2", "first"), "suffix-window")
    single = win.join(least, ["w1", "w2"]).where(at > F.col("first")).select(
        "doc_id", "tkey", "s", (F.col("s") + length).alias("e"))
    return whole.unionByName(single)


def merged(spans) -> list[list[int]]:
    """Maximal runs of sorted (s, e) spans; touching spans join."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def repeats(documents: DataFrame, length: int = LENGTH, segment: int = SEGMENT) -> DataFrame:
    """(doc_id, tkey, n_bytes, sha256, copy, spans): ``copy`` marks a document that an earlier one
    equals (all of it goes if it has ``length`` bytes), ``spans`` the other removed spans, unmerged;
    ``sha256`` is that of the whole text."""
    small_batches(documents.sparkSession)
    keyed = documents.select("doc_id", F.xxhash64("text").alias("tkey"), "text")
    raw = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    base = written(keyed.select("doc_id", "tkey", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                                F.md5(raw).alias("full"), F.sha2(raw, 256).alias("sha256")).distinct(),
                   "suffix-base")
    known = base.where(F.col("doc_id").isNotNull() & (F.col("n_bytes") >= length))
    classes = written(known.groupBy("full", "n_bytes").agg(
        F.min(F.struct("doc_id", "tkey")).alias("first"), F.count("*").alias("k"))
        .where("k > 1").select("full", "n_bytes", "first"), "suffix-classes")
    copies = written(known.join(classes, ["full", "n_bytes"])
                     .where(F.struct("doc_id", "tkey") > F.col("first")).select("doc_id", "tkey"), "suffix-copies")
    docs = keyed.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length))
    docs = docs.join(broadcast_checked(copies, MAX_BROADCAST), ["doc_id", "tkey"], "left_anti")

    repeated = anchor_counts(docs, length, segment)
    mine = anchor_rows(docs, length, segment).join(broadcast_checked(repeated, MAX_BROADCAST), "h")
    # a repeated row of the table is one document: its anchors count once; an anchor that windows on
    # both sides of a segment's end have chosen is two rows, with different windows
    mine = written(mine.dropDuplicates(["doc_id", "tkey", "a", "lo"]), "suffix-anchors")
    few = mine.where(F.col("n") <= HOT)
    # a task holds its whole partition, so the number of partitions follows the rows
    parts = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                math.ceil(few.count() / TASK_ROWS))
    cold = contexts(docs, few, length)
    spans = written(cold_spans(cold, length, parts), "suffix-cold")
    hot = written(contexts(docs, mine.where(F.col("n") > HOT), length), "suffix-hot")
    spans = spans.unionByName(written(hot_spans(hot, length), "suffix-hot-spans"))
    per = spans.groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    flagged = copies.withColumn("copy", F.lit(True))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["tkey"].eqNullSafe(b["tkey"])
    out = base.join(flagged, same(base, flagged), "left").select(base["*"], "copy")
    out = out.join(per, same(out, per), "left").select(out["*"], "spans")
    return out.select("doc_id", "tkey", "n_bytes", "sha256", F.coalesce("copy", F.lit(False)).alias("copy"), "spans")


def report(documents: DataFrame, length: int = LENGTH, segment: int = SEGMENT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""
    got = written(repeats(documents, length, segment), "suffix-report")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    plain = got.where("copy or spans is null").select(
        "doc_id", "n_bytes", F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.col("copy").cast("long").alias("n_spans"),
        F.when(F.col("copy"), empty).otherwise(F.col("sha256")).alias("kept_sha256"))
    cut = got.where("not copy and spans is not null").select("doc_id", "tkey", "n_bytes", "spans")
    docs = documents.select("doc_id", F.xxhash64("text").alias("tkey"), "text")
    ids = broadcast_checked(cut.select("doc_id", "tkey"), MAX_BROADCAST)
    docs = docs.join(ids, ["doc_id", "tkey"], "left_semi").dropDuplicates(["doc_id", "tkey"])

    def run(batches):
        for b in batches:
            d = b.to_pydict()
            cols = [[] for _ in range(5)]
            for i, n, t, spans in zip(d["doc_id"], d["n_bytes"], d["text"], d["spans"]):
                raw, at, keep = t.encode("utf-8"), 0, hashlib.sha256()
                runs = merged((x["s"], x["e"]) for x in spans)
                for s, e in runs:
                    keep.update(raw[at:s])
                    at = e
                keep.update(raw[at:])
                row = (i, n, sum(e - s for s, e in runs), len(runs), keep.hexdigest())
                for c, v in zip(cols, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, y) for c, y in zip(cols, [pa.int64()] * 4 + [pa.string()])],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    done = docs.join(cut, ["doc_id", "tkey"]).select("doc_id", "n_bytes", "text", "spans").mapInArrow(
        tidy(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return plain.unionByName(done)
