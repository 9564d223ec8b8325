"""Operators against brute force on sf0.001, and the edge cases their docstrings define."""

import random

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderlens.llm import (catalog, decontam, embed_dedup, html_text, near_dup, pieces, quality, secrets,
                           suffix_dedup, toxicity, url_filter)

SF = "/root/testdata/sf0.001"
KEY = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
EDGE = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two three four five six"),
        (5, "one two three four five six"), (6, LONG), (7, LONG + " tail"), (None, "null id text here now"),
        (8, "Ünï ▁ code \x00 𝔘 words"), (9, f'Token = "{KEY}"'), (10, "one two three four five six")]


def rows(name):
    return duckdb.sql(f"select * from '{SF}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def docs(spark):
    """The edge rows with extra columns whose names clash with results and helpers."""
    df = spark.createDataFrame(EDGE, "doc_id long, text string")
    for c in ("score", "n_words", "ids", "component_id", "h", "a", "b", "set_id", "spans", "kept"):
        df = df.withColumn(c, F.lit("x"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, kept string")


def by_id(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) for r in df.collect()}


# ------------------------------------------------------------- brute force

@pytest.mark.parametrize("op, expected, cols", [
    ("op1_secret_scan", lambda d: {i: brute.secrets_base(t) for i, t in d},
     ("n_assign", "n_access", "n_hex", "base_sha256")),
    ("op3_decontamination", lambda d: brute.decontam(d, rows("benchmark")),
     ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")),
    ("op7_minhash_near_dup", brute.near_dups, ("n_shingles", "component_id", "kept")),
    ("op10_suffix_dedup", brute.suffix, ("n_bytes", "n_removed", "n_spans", "kept_sha256"))])
def test_documents_against_brute_force(spark, op, expected, cols):
    want = expected([r[:2] for r in rows("documents")])
    assert by_id(catalog.QUERIES[op](spark, SF), "doc_id", *cols) == want


def test_embeddings_against_brute_force_with_close_pairs_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 16))
    near = base[:120] + rng.normal(size=(120, 16)) * rng.uniform(0.05, 0.12, size=(120, 1))
    data = [[float(np.float32(x)) for x in v] for v in np.vstack([base, near, base[:5], base[5:9] * 7])]
    data += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    vecs = list(enumerate(data))
    df = spark.createDataFrame(vecs + vecs[:3], "vec_id long, embedding array<float>").withColumn("links", F.lit(1))
    got = by_id(embed_dedup.report(df, block=40), "vec_id", "n_links", "component_id", "kept")
    want = brute.cosine_links([(i, v) for i, v in vecs])
    links = sum(w[0] for w in want.values())
    assert links > 100
    assert sum(got[i][0] for i in want) >= 0.9 * links                 # measured recall of the index
    assert all(got[i][0] <= want[i][0] for i in want)                  # nothing below the threshold
    assert {i for i in want if got[i] != want[i]} <= {i for i in want if got[i][0] < want[i][0]} | {
        i for i in want if want[i][1] != got[i][1]}


@pytest.mark.parametrize("n", [1200, 4800])
def test_embeddings_recall_in_a_dense_cluster(spark, n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    x[:n // 3] = rng.normal(size=64) + 0.3 * rng.normal(size=(n // 3, 64))     # a third lies around one centre
    x = np.float32(x[rng.permutation(n)]).astype(np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((u @ u.T) >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    got = by_id(embed_dedup.report(df), "vec_id", "n_links", "component_id")
    assert want.sum() > n * n / 30
    assert all(got[i][0] <= want[i] for i in range(n))
    assert sum(g[0] for g in got.values()) >= 0.97 * want.sum()


def test_embeddings_empty(spark):
    assert embed_dedup.report(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


# ------------------------------------------------------------- edge cases

def test_decontam_rows_stay_small(spark, monkeypatch):
    """Positions of a text are rows of generated code, not one array of structs and texts a document;
    a hit takes along the hits that a window over it reaches, not all of its document."""
    plans, write = {}, decontam.written
    monkeypatch.setattr(decontam, "written", lambda df, tag: plans.setdefault(
        tag, df._jdf.queryExecution().optimizedPlan().toString()) and write(df, tag))
    items = [(i, " ".join(f"x{i}y{k}" for k in range(40))) for i in range(20)] + [(20, "X1y7, x1y8"), (21, "x2Y5")]
    texts = [(1, " ".join(t for _, t in items) * 3), (2, " ".join(t[:90] for _, t in items)), (3, "no hit")]
    got = by_id(decontam.report(spark.createDataFrame(texts, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string")),
                "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.decontam(texts, items)
    assert "lambda" not in plans["decontam-hits"]

    hits = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(4_999)), lambda i: F.struct(
        (i * 2).alias("pos"), (i + 7).alias("gid"))).alias("h"))
    rows = hits.select(F.explode(decontam.around("h", 7)).alias("x")).select("x.*")
    assert rows.agg(F.max(F.size("h"))).head()[0] == 15
    own = F.get("h", F.col("at"))
    assert rows.where((own["pos"] == F.col("pos")) & (own["gid"] == F.col("gid"))).count() == 5_000


def test_edge_rows(spark, docs, none):
    bench = spark.createDataFrame([(1, "TWO three four five"), (1, "TWO three four five"), (2, None), (3, "..."),
                                   (None, "three four"), (4, LONG[:400])], "item_id long, text string")
    got = by_id(decontam.report(docs, bench), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute.decontam(EDGE, [(i, t) for i, t in ((1, "TWO three four five"), (3, "..."), (None, "three four"),
                                                      (4, LONG[:400]))])
    for i, w in want.items():
        assert got[i][:2] == w[:2] and got[i][3:] == w[3:], i
    assert decontam.report(none, bench).collect() == []
    assert not any(r["contaminated"] for r in decontam.report(docs, bench.where("item_id = 2")).collect())

    near = by_id(near_dup.report(docs), "doc_id", "n_shingles", "component_id", "kept")
    want = brute.near_dups([x for x in EDGE if x[0] is not None])
    assert {i: near[i] for i in want} == want
    assert near[None][1:] == (None, True)
    assert near_dup.report(none).collect() == []
    left = near_dup.keep_first(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == sorted(
        [0] + [i for i, w in want.items() if w[2]])

    cut = by_id(suffix_dedup.report(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = brute.suffix({i: t for i, t in EDGE if i is not None}.items())
    assert {i: cut[i] for i in want} == want
    assert suffix_dedup.report(none).collect() == []

    found = by_id(secrets.scan(docs), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert found == {i: brute.secrets_base(t) for i, t in EDGE}
    assert secrets.scan(none).collect() == []
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert KEY not in clean[9] and clean[4] == "one" and clean[1] is None and len(clean) == 11

    ids = by_id(pieces.digest(docs), "doc_id", "n_ids", "exact")
    assert ids[1] == (0, None) and ids[2] == (0, True) and all(x[1] for i, x in ids.items() if i != 1)
    assert pieces.encode(none).collect() == []

    model = quality.fit(docs)
    judged = by_id(quality.score(docs, model), "doc_id", "kept", "score")
    assert judged[1][0] is False and judged[2][0] is False
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.score(none, quality.fit(none)).collect() == []

    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    for y in (labels, labels.where("toxic = 0"), labels.where("toxic = 7")):
        got = toxicity.score(docs, toxicity.fit(docs, y)).collect()
        assert len(got) == len(EDGE) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(none, toxicity.fit(none, labels)).collect() == []


# ------------------------------------------------------------- secrets

def test_automaton_learns_the_format():
    rng = random.Random(5)
    values = ["KX-" + "".join(rng.choice("0123456789ABCDEF") for _ in range(20)) for _ in range(150)]
    pfa, least = secrets.fit({"access": values})["access"]
    assert len(pfa) < 60                                       # states were merged
    other = "KX-" + "".join(rng.choice("0123456789ABCDEF") for _ in range(20))
    assert secrets.likelihood(pfa, other) >= least
    assert secrets.likelihood(pfa, "international-words-2024") < least


def test_format_spans_are_added(spark):
    rng = random.Random(6)
    tok = lambda: "".join(rng.choice("0123456789ABCDEFGH") for _ in range(24))
    data = [(i, f'secret = "{tok()}" done') for i in range(60)] + [(99, f"plain {tok()} text; very-long-word-2-here-ok")]
    got = by_id(secrets.scan(spark.createDataFrame(data, "doc_id long, text string")), "doc_id", "spans", "n_assign")
    assert got[99] == ("format:6:30", 0)
    assert got[0][1] == 1


# ------------------------------------------------------------- pieces

def test_stream_equals_full_viterbi():
    codec, rng = pieces.Codec(), random.Random(1)
    for k in range(300):
        s = "".join(rng.choice(["▁", " ", "the", "caé", "ÿ", "\n", "--", "==", "ing", "tion", "𝔘", ".", "a"])
                    for _ in range(rng.randint(0, 60)))
        assert codec.encode(s) == brute.viterbi(codec, s)
        assert codec.decode(codec.encode(s)) == s
    s = "".join(rng.choice("abcdefinorst") for _ in range(5000))    # one long stretch: the window commits
    assert codec.encode(s) == brute.viterbi(codec, s)


# ------------------------------------------------------------- near-duplicates

def test_sketch_finds_pairs_at_the_threshold_and_small_sets():
    rng = np.random.default_rng(2)
    missed = 0
    for _ in range(200):
        pool = np.unique(rng.integers(1, 1 << 63, 300).astype(np.uint64))
        a, b = pool[:276], pool[24:300]                             # Jaccard 0.84 to 0.86
        missed += not (near_dup.band_keys(near_dup.signature(a)) == near_dup.band_keys(near_dup.signature(b))).any()
    assert missed == 0
    one = np.array([12345], dtype=np.uint64)
    assert (near_dup.signature(one) == 12345).all()


def test_edited_copies_of_a_middle_document_are_one_group(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(304)]
    data = [(500, " ".join(words))]
    for i in [*range(500), *range(501, 1000)]:          # original-copy 0.875, copy-copy 0.77
        w = list(words)
        for at in rng.sample(range(6, 298, 6), 4):
            w[at] = f"e{i}x{at}"
        data.append((i, " ".join(w)))
    got = by_id(near_dup.report(spark.createDataFrame(data, "doc_id long, text string")), "doc_id", "component_id")
    assert len(got) == 1000 and set(got.values()) == {(0,)}


def test_keep_first_keeps_null_ids_and_texts_that_differ(spark):
    data = [(None, "first text without an id"), (None, "second text without an id"), (1, "one two three four five six"),
            (2, "alpha beta gamma delta epsilon"), (2, "red green blue white black"), (2, "red green blue white black"),
            (3, "one two three four five six"), (3, "sun moon star sky cloud")]
    left = near_dup.keep_first(spark.createDataFrame(data, "doc_id long, text string"))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == sorted(
        (i or 0, t) for i, t in set(data) - {(3, "one two three four five six")})


# ------------------------------------------------------------- urls

def test_urls(spark):
    data = [(1, "http://A.com/x?y"), (2, "https://www.Example.com/en/1#t"), (3, "http://b.example.com/en/2"),
            (4, "http://q.net/es/1"), (5, "nonsense"), (6, None), (7, "http://a.com"), (8, "http://notcom/x"),
            (8, "http://notcom/x"), (None, "http://evil.org/casino/1")]
    data += [(100 + i, f"http://site{i}.com/news/{i}") for i in range(60)]
    data += [(200 + i, f"http://casino{i}.net/es/casino/{i}") for i in range(60)]
    got = by_id(url_filter.judge(spark.createDataFrame(data, "page_id long, url string")), "page_id",
                "host", "path", "rule", "verdict")
    assert got[1] == ("a.com", "/x", "com/", "allow")
    assert got[2] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[3] == ("b.example.com", "/en/2", "example.com/en/", "block")
    assert got[4][2:] == ("net/es/", "block")
    assert got[5][:3] == ("", "", None) and got[6][:3] == ("", "", None) and got[7][:3] == ("a.com", "", None)
    assert got[8][2] is None and got[None][3] == "block"
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty).collect() == []


# ------------------------------------------------------------- html

def test_html():
    page = ('<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><nav><a href=x>Menu</a></nav>'
            '<header><p>Site</p></header><div class="cookie-notice">We use cookies, many cookies, on this page.</div>'
            '<article><h1>Head&amp;line</h1><p>First <b>bo</b>ld&nbsp;text<br>more.<p>Second.</p>'
            '<script>var a="</p>";</script><form><p>Mail</p></form><aside>side</aside><p>x</p></article>'
            '<div id="comments"><p>A long reader comment that should go away, really long.</p></div>'
            '<footer>foot</footer></body></html>')
    assert html_text.main_text(page) == "Head&line First bold text more. Second. x"
    plain = ("<body><ul><li><a href=1>one link</a><li><a href=2>two</a></ul><div>" +
             "".join(f"<p>Sentence number {i} of the body text.</p>" for i in range(6)) +
             "</div><div></div><div></div><div></div><p>imprint</p></body>")
    got = html_text.main_text(plain)
    assert got.startswith("Sentence number 0") and "number 5" in got and "imprint" not in got
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("<p>cut <b>off &am") == "cut off &am"
    assert html_text.main_text("<p>cut<a hr") == "cut"
    assert html_text.main_text("<!-- open <p>x") == ""


# ------------------------------------------------------------- learned models on held-out labels

def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = catalog.op2_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right = got.select(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0]
    lost = got.where("quality = 1 and not kept").count() / got.where("quality = 1").count()
    assert right > 0.95 and lost < 0.03


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = (catalog.op4_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
           .where("held_out").select("score", "toxic").collect())
    pos, neg = [r[0] for r in got if r[1]], [r[0] for r in got if not r[1]]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]) > 0.8     # 36 label-1 rows to learn from
    bags = [[["good", "day"], ["you", "idiotic"]], [["good"], ["day"]]] * 30
    model = toxicity.fit_bags(bags, np.array([1, 0] * 30), np.ones(60))
    text = "Good day to all. You idiotic one! Day."
    s, e, p = max(toxicity.sentence_scores(text, model), key=lambda x: x[2])
    assert "idiotic" in text[s:e] and toxicity.document_score(text, model) > 0.3 > toxicity.document_score("Good.", model)


# ------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, before = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SF).cache()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == cols, name
        old = [(r["doc_id"], r["text"]) for r in before.collect()]
        ids = {r["doc_id"] for r in after.collect()}
        if k == 1:
            assert ids == {i for i, x in brute.near_dups(old, link=80).items() if x[2]}
        if k == 2:
            assert ids == {i for i, x in brute.decontam(old, rows("benchmark")).items() if not x[4]}
        if k >= 3:
            assert ids == {i for i, _ in old}
        if k == 4:
            codec = pieces.Codec()
            assert {r["doc_id"]: codec.decode(r["ids"]) for r in after.collect()} == dict(old)
        before = after


def test_suffix_passes_take_small_batches_and_tasks(spark, docs):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.unset(key)
    suffix_dedup.report(docs).collect()
    assert int(spark.conf.get(key)) <= 1_000         # long texts: a batch is what a worker holds
    assert suffix_dedup.TASK_ROWS <= 50_000


def test_models_are_fitted_on_all_rows(spark):
    rng = random.Random(9)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(20)) for _ in range(900)]
    data = [(i, f"key {h} end") for i, h in enumerate(hexes)] + [(1000, None), (1001, "")]
    table = secrets.extract(spark.createDataFrame(data, "doc_id long, text string"))
    pfa, least = secrets.train(table)["hex"]
    seen = sum(round(np.exp(p), 9) > 0 for p, _ in pfa[0][1].values())
    assert seen == 16                                  # every symbol of every value has a count
    counts = {r["ch"]: r["n"] for r in secrets.path_counts(
        table.selectExpr("explode(labelled) value").selectExpr("'hex' kind", "value"), {"hex": [{}]}).collect()}
    assert counts[""] == 900 and sum(counts.values()) == 900 * 21
    scores = sorted(secrets.likelihood(pfa, h) for h in hexes)
    assert abs(least - (scores[9] - secrets.MARGIN)) < 1e-9
    assert not hasattr(quality, "MAX_TRAIN")
    docs = spark.createDataFrame([(i, "Some plain words stand in this line. " * (1 + i % 5)) for i in range(50)]
                                 + [(99, None)], "doc_id long, text string")
    assert quality.measured(docs).count() == 51
