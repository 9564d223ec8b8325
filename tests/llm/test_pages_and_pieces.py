"""Page extraction and url rules as DataFrames, decoding, and whole-word shapes of the quality scorer."""

from pyspark.sql import functions as F

from orderlens.llm import html_text, pieces, quality, url_filter

TEXT = "This is a paragraph of the article with quite a few words. " * 3


def p(s):
    return f"<p>{s}</p>"


def test_gaps_articles_headers_and_formulas_stay():
    page = "<nav><a href='/'>home</a></nav>" + p(TEXT) + "<figure><img src='x'></figure>" * 3 + p("After the gap. " + TEXT)
    assert html_text.main_text(f"<body>{page}<footer>foot</footer></body>") == " ".join(f"{TEXT} After the gap. {TEXT}".split())
    two = f"<body><article>{p(TEXT)}</article><div class='ad'>buy</div><article>{p('A short one.')}</article></body>"
    assert html_text.main_text(two) == TEXT.strip() + " A short one."
    own = (f"<article><div class='post-header'><h1>Title</h1></div>{p(TEXT)}<div class='notice-period'>three months</div>"
           "<math><mi>x</mi><mo>=</mo><mn>2</mn></math><div class='share-buttons'>Share</div>"
           "<div id='comments'>a reader</div></article>")
    assert html_text.main_text(own) == f"Title {TEXT}three months x=2"


def test_extraction_of_frames(spark):
    page = f"<html><body><article>{p('Über &amp; out.')}{p(TEXT)}</article></body></html>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "<p>cut off <b"),
            (4, "x", "<article>" + p(TEXT) * 3000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("text", "n_chars", "lines", "_text_in"):
        df = df.withColumn(c, F.lit("clash"))
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in html_text.extract(df.repartition(3)).collect()),
                 key=str)
    want = sorted(((i or 0, u, t := html_text.main_text(h), len(t)) for i, u, h in rows), key=str)
    assert got == want and html_text.extract(df).columns == ["page_id", "url", "text", "n_chars"]
    assert got[1][2].startswith("Über & out. This")
    assert html_text.extract(df.limit(0)).collect() == []


def test_urls_with_clashing_columns_and_length(spark):
    long_ = "http://www.example.com/en/" + "a/" * 30_000
    rows = [(1, long_), (2, None), (2, None), (3, "no scheme"), (None, "https://A.COM/x"), (4, "ftp://x.net/es/" + "é" * 500)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {c: F.lit("clash") for c in ("host", "path", "rule", "verdict", "h", "n")})
    got = [tuple(r) for r in url_filter.judge(df).select("page_id", "host", "rule", "verdict").collect()]
    assert len(got) == len(rows) and all(v in ("allow", "block") for *_, v in got)
    by = {r[0]: r for r in got}
    assert by[1][1:] == ("www.example.com", "www.example.com/en/", "allow") and by[4][2:] == ("net/es/", "block")
    assert by[None][1:] == ("a.com", "com/", "allow") and by[3][1:3] == ("", None) and by[2][1:3] == ("", None)
    assert url_filter.judge(df.limit(0)).collect() == []


def test_decoding_is_the_inverse_of_encoding(spark):
    texts = ["", "one two  three", "Ünï ▁ code \x00 𝔘\n\nwords ", "a" * 5000, " lead", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    back = pieces.decode(pieces.encode(df))
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts))
    assert pieces.decode(pieces.encode(df.limit(0))).collect() == []


def test_shapes_and_sentence_ends_of_long_words():
    known = quality._Shapes()
    long_ = b"a" * 150 + b"," + b"a0" * 100 + b"."
    assert known[long_][2] and not known[long_[:-1]][2]
    assert known[long_][0] != known[long_[:-1] + b"!"][0]
    a, b = quality.measures("word " * 10 + "x" * 300 + ".", known), quality.measures("word " * 10 + "x" * 300, known)
    assert a["stops"] > b["stops"] == 0


def test_repeated_rows_and_ties_get_equal_quality_scores(spark):
    rows = [(1, TEXT * 4), (2, TEXT * 4), (2, TEXT * 4), (3, "#### $$$$ %%%% " * 20), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = quality.score(df, quality.fit(df)).collect()
    assert len(got) == len(rows)
    scores = {}
    for r in got:
        scores.setdefault(r["doc_id"], set()).add(r["score"])
    assert scores[1] == scores[2] and all(len(s) == 1 for s in scores.values()) and scores[4] == scores[5]
