"""Spelling variants, filter audit and token files: brute force, edge rows and the file format."""

import random
import zlib
from itertools import permutations

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import catalog, filter_audit, token_files, variants

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"wörd{'abcdefg'[i % 7]}xy{'hijklmnop'[i % 9]}zz" for i in range(20_000))
EDGE = [(3, None, "en"), (2, "", None), (1, "   \n\t ", ""), (4, LONG, "en"), (5, LONG, "de"), (5, LONG, "de"),
        (None, LONG, "en"), (None, LONG, None), (6, "Spelling spelling speling spellings " * 40 + "#", "fr"),
        (7, "spellinG \x00 ÿellow×÷ <|endoftext|> it's 'S ́e Σ  ΑΣ", "fr"), (8, "x" * 70_000, "en"),
        (9, "spelling " * 500, "en"), (5, "another text of five", "de")]


def rows(name, cols="*"):
    return duckdb.sql(f"select {cols} from '{SF}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def edge(spark):
    """The edge rows with extra columns whose names clash with results and helpers."""
    df = spark.createDataFrame(EDGE, "doc_id long, text string, lang string")
    for c in ("n", "word", "start", "h", "r", "part", "mask", "sha", "step", "key", "length", "shard", "n_tokens"):
        df = df.withColumn(c, F.lit("x"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n string")


LABELS = [(4, 1, 1), (4, 0, 0), (5, None, 1), (None, 1, 1), (6, 1, None)]


@pytest.fixture(scope="module")
def marks(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("n", F.lit("x"))


# ------------------------------------------------------------- spelling variants

def as_words(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_against_brute_force(spark):
    want = brute.variants(rows("documents", "doc_id, text"))
    got = as_words(catalog.QUERIES["op11_spelling_variants"](spark, SF))
    assert got == want and any(form for form, *_ in want.values())


def test_variants_edge_rows(spark, edge, none):
    assert as_words(variants.report(edge)) == brute.variants([r[:2] for r in EDGE])
    assert variants.report(none).collect() == []


def test_long_lists_and_frequent_grams_lose_no_pair(spark, monkeypatch):
    rng = random.Random(5)
    base = ["".join(rng.choice("abë") for _ in range(rng.randint(7, 9))) for _ in range(900)]
    docs = [(k, " ".join(rng.choice(base) for _ in range(40))) for k in range(150)]
    monkeypatch.setattr(variants, "BLOCK", 7)
    monkeypatch.setattr(variants, "HELD", 50)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert as_words(variants.report(df)) == brute.variants(docs)


def test_near_words_share_a_listed_gram():
    rng = random.Random(6)
    common = {"".join(g): 9 for q in (2, 3, 4) for g in {tuple(rng.choice("ab") for _ in range(q)) for _ in range(9)}}
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(7, 12)))
        i = rng.randrange(len(a) + 1)
        b = a[:i] + rng.choice("abc") + a[i + rng.randint(0, 1):]
        if b == a or len(b) < 7:
            continue
        shift = {(g, p) for g, p in variants.listed(a, common)}
        if len(b) > len(a):
            shift |= {(g, p + 1) for g, p in shift}
        assert shift & set(variants.listed(b, common)), (a, b)


# ------------------------------------------------------------- filter audit

def as_steps(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                               r.toxic_lost, r.shapley) for r in df.collect()}


def test_audit_against_brute_force(spark):
    want = brute.filter_audit(rows("documents", "doc_id, text, lang"), rows("labels", "doc_id, quality, toxic"))
    assert as_steps(catalog.QUERIES["op12_filter_audit"](spark, SF)) == want


def test_audit_edge_rows(spark, edge, none, marks):
    assert as_steps(filter_audit.report(edge, marks)) == brute.filter_audit(EDGE, LABELS)
    assert filter_audit.report(none, marks).collect() == []


def test_lehmer_ranks_and_intervals():
    orders = ["".join(p) for p in permutations("ABCDE")]
    assert [filter_audit.lehmer_rank(o) for o in orders] == list(range(120))
    for mask, step, letter, here, single, lo, hi in filter_audit.intervals():
        for o in orders[lo:hi]:
            before = {c for c in o[:step - 1] if mask >> "ABCDE".index(c) & 1}
            assert o[step - 1] == letter and here == (not before) and single == (mask == 1 << "ABCDE".index(letter))


# ------------------------------------------------------------- token files

TOK = Tokenizer.from_file(token_files.TOKENIZER)


def as_tokens(df):
    return {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in df.collect()}


def test_token_files_against_whole_text_encoding(spark):
    want = brute.token_files(rows("documents", "doc_id, text"), TOK)
    assert as_tokens(catalog.QUERIES["op13_token_files"](spark, SF)) == want


def test_token_files_edge_rows(spark, edge, none):
    got = sorted((r.start, r.doc_id is not None, r.doc_id, r.n_tokens, r.ids_crc32)
                 for r in token_files.report(edge).collect())
    assert [r[1:3] for r in got] == sorted((i is not None, i) for i, _, _ in EDGE)
    ids = {t: TOK.encode(t or "", add_special_tokens=False).ids + [1] for _, t, _ in EDGE}
    want = sorted((len(ids[t]), zlib.crc32(np.array(ids[t], dtype="<u4").tobytes())) for _, t, _ in EDGE)
    assert sorted(r[3:] for r in got) == want
    assert [r[0] for r in got] == np.cumsum([0, *(r[3] for r in got)])[:-1].tolist()
    assert token_files.report(none).collect() == []


def test_sequences_and_masks_are_views_of_equal_length(spark, tmp_path):
    docs = [(k, " ".join(f"token{j}" for j in range(k % 50))) for k in range(300)]
    folder = str(tmp_path / "out")
    manifest = token_files.write_token_files(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                                             folder, length=64, sequences=5)
    flat = []
    for r in manifest.orderBy("shard").collect():
        file, part = token_files.TokenFile(folder, r.path), []
        assert r.base == len(flat)
        for k in range(r.n_sequences):
            ids, mask = file.sequence(k)
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata
            assert mask.to_pylist() == [64 * k + j < r.n_ids for j in range(64)]
            part += ids[:mask.true_count].tolist()
        got = [x for view in file.ids(10, r.n_ids - 10) for x in view.tolist()]
        assert got == part[10:] and len(part) == r.n_ids
        flat += part
        file.close()
    assert flat == [i for _, t in docs for i in TOK.encode(t, add_special_tokens=False).ids + [1]]


def test_tokenizers_that_keep_spaces_get_whole_texts():
    enc = token_files.Encoder("/opt/tokenizers/byte_bpe_50k.json")
    tok = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    assert not enc.by_word
    assert enc.encode("a  b c") == tok.encode("a  b c").ids


def test_words_and_pieces_give_the_ids_of_whole_texts():
    enc, rng = token_files.Encoder(), random.Random(1)
    odd = ["a", "B", "é", "É", "İ", "ı", "ſ", "ß", "ẞ", "Σ", "'", "'s", "'LL", "\u0301", "1", "²", "¼", "<|endoftext|>",
           "<|", "\x00", "\x1c", "\x85", "\xa0", " ", "  ", "\n", ".", "@", "ŉ", "Ĳ", "×", "ª", "𝔘", "中", "ё", "_"]
    assert enc.known
    for _ in range(3000):
        s = "".join(rng.choice(odd) for _ in range(rng.randint(0, 12)))
        assert enc.encode(s) == TOK.encode(s, add_special_tokens=False).ids, s


# ------------------------------------------------------------- embeddings with a common direction

def _unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


@pytest.mark.parametrize("common", [0.0, 0.5, 0.7])
@pytest.mark.parametrize("n, most", [(2_500, 0.3), (10_000, 0.12)])
def test_index_recall_and_candidates_whatever_the_mean_cosine(common, n, most):
    from orderlens.llm import embed_dedup
    rng = np.random.default_rng(n)
    x = _unit(np.sqrt(common) * _unit(rng.normal(size=64)) + np.sqrt(1 - common) * _unit(rng.normal(size=(n, 64))))
    a = x[:400]                                                     # partners at a cosine of 0.9 to 0.93
    side = rng.normal(size=a.shape)
    side = _unit(side - (side * a).sum(axis=1, keepdims=True) * a)
    cos = rng.uniform(0.9, 0.93, size=(400, 1))
    x = np.vstack([x, cos * a + np.sqrt(1 - cos ** 2) * side])
    k = int(np.ceil(embed_dedup.PIVOTS_PER_ROOT * np.sqrt(len(x))))
    pivots, centre = embed_dedup.choose_pivots(x[rng.permutation(len(x))[:k]], 4 * embed_dedup.NEAREST)
    near = embed_dedup.nearest_pivots(embed_dedup._from(x, centre), pivots, embed_dedup.NEAREST)
    member = np.zeros((len(x), len(pivots)), dtype=np.float32)
    np.put_along_axis(member, near.astype(np.int64), 1, axis=1)
    shared = (member[:400] * member[n:]).sum(axis=1)
    assert (shared >= embed_dedup.MIN_SHARED).mean() >= 0.95
    assert (member[:500] @ member.T >= embed_dedup.MIN_SHARED).mean() < most


# ------------------------------------------------------------- repeats over segment ends

def test_repeats_over_segment_ends(spark):
    from orderlens.llm import suffix_dedup
    rng = random.Random(11)
    passage = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(100, 400))) for _ in range(12)]
    docs = [(k, "".join(rng.choice(passage) if rng.random() < 0.6 else "".join(
        rng.choice("xyzuvw ") for _ in range(rng.randint(20, 300))) for _ in range(30))) for k in range(11)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.report(df, segment=500).collect()}
    assert got == brute.suffix(docs)
