from __future__ import annotations

import hashlib
import struct

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import byte_bpe, hard_negatives, registry, sort_means

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], label) for i, v, label in rows], VECTORS)


def with_clashes(df):
    for c in ("v", "cluster", "distance", "slot", "rank", "score", "codes", "residual", "ids", "anchor_id"):
        df = df.selectExpr("*", f"1 as `{c}`")
    return df


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    df = registry.QUERIES[name](spark, SF)
    found = con.execute(registry.ORACLES[name])
    at = [[d[0] for d in found.description].index(c) for c in df.columns]
    assert sorted(tuple(r) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in found.fetchall())


# hard negatives

def plain_negatives(rows, every=50, positives=5, negatives=3):
    known = {i: (label, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v, label in rows}
    out = []
    for a in sorted(i for i in known if i % every == 0):
        score = {b: sum(x * y for x, y in zip(known[a][1], known[b][1], strict=False)) for b in known if b != a}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if known[b][0] == known[a][0]][:positives]:
            fit = [b for b in order if known[b][0] != known[a][0] and 50 * score[p] <= 100 * score[b] <= 95 * score[p]]
            out += [(a, p, k + 1, b, score[p], score[b]) for k, b in enumerate(fit[:negatives])]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(df, lambda i: i % 50 == 0, **options).collect())


def test_negatives_by_brute_force_with_copies_ties_and_short_vectors(spark, monkeypatch):
    """Blocks of few anchors, tables of few anchors, and pairs in small runs give the same rows."""
    for name, n in (("BLOCK", 2), ("TABLES", 3), ("PAIRS", 7), ("ROWS", 64)):
        monkeypatch.setattr(hard_negatives, name, n)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.3, 7).round(1), int(rng.integers(0, 3))) for i in range(260)]
    rows += [(300 + i, rows[3][1], int(i % 2)) for i in range(120)]  # one vector under two labels
    rows += [(500 + i, rng.normal(0, 0.3, int(rng.integers(0, 5))).round(1), 1) for i in range(20)]
    want = plain_negatives(rows)
    assert len(want) > 30
    assert mined(vectors(spark, rows).repartition(3)) == want
    assert mined(with_clashes(vectors(spark, rows)), sample=10) == want


def test_negatives_leave_out_unsound_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 0.3, 4), i % 3) for i in range(120)]
    odd = [(None, rows[0][1], 1), (1000, None, 1), (1001, [1, None, 1, 1], 1), (1002, [1, float("nan"), 1, 1], 1), (1003, [float("inf"), 0, 0, 0], 1), (1004, rows[0][1], None), (1005, [3e30, 0, 0, 0], 0), (50, [9, 9, 9, 9], 9), rows[100]]
    assert mined(vectors(spark, rows + odd)) == plain_negatives(rows)
    assert mined(vectors(spark, odd[:4])) == [] and mined(vectors(spark, [])) == []


def test_bounds_hold_and_spare_products():
    """Every row is within the bounds, and few inner products are computed."""
    rng = np.random.default_rng(7)
    x = np.floor(256 * rng.normal(0, 0.125, (6000, 64))).astype(np.int64)
    books = hard_negatives.train(x[:2000], 64)
    codes = books.codes(x)
    residual = books.residuals(x, codes)
    looked = np.zeros((len(x), 20), np.float32)
    tables = books.tables(x[:20])
    for m in range(len(tables)):
        looked += tables[m][codes[:, m]]
    exact = x @ x[:20].T
    assert (np.abs(exact - looked) <= residual[:, None] * np.linalg.norm(x[:20], axis=1)[None]).all()
    ids, labels = np.arange(len(x)), rng.integers(0, 10, len(x))
    search = hard_negatives.Search(ids[:20], labels[:20], x[:20], np.full((20, 1), hard_negatives.NONE), np.full((20, 1), -hard_negatives.NONE), True, 5)
    best = hard_negatives.Best.of(20, 5)
    assert hard_negatives.scan(search, books, best, ids, labels, x, codes, residual) < 0.05 * 20 * len(x)
    for a in range(20):
        order = sorted((b for b in ids if labels[b] == labels[a] and b != a), key=lambda b: (-exact[b, a], b))[:5]
        assert best.ids[a].tolist() == order


# centroids

def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(64 * float(np.float32(c)))) for c in v]) for i, v, _ in rows]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centroids = [v for _, v in first]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((square(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, members in groups.items():
            centroids[n] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    got = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in got)
    inertia = {n: sum(d for _, d, m in got if m == n) for n in range(len(centroids))}
    return sorted((i, n, d, inertia[n], total, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in got)


def test_clusters_by_plain_rounds(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (5, 64))
    rows = [(i, centres[i % 5] + rng.normal(0, 0.2, 64), 0) for i in range(200)]
    rows += [(200 + i, rows[7][1], 0) for i in range(90)] + [(300 + i, np.zeros(64), 0) for i in range(3)]
    rows += [rows[0], rows[0]]
    odd = [(400, None, 0), (401, [0.5] * 63, 0), (402, [0.5] * 65, 0), (403, [0.5] * 63 + [None], 0), (404, [0.5] * 63 + [float("nan")], 0), (405, [float("-inf")] + [0.5] * 63, 0), (406, [1e30] * 64, 0), (407, [], 0)]
    got = sorted(tuple(r) for r in sort_means.sort_means(with_clashes(vectors(spark, rows + odd)).repartition(3)).collect())
    assert got == plain_clusters(rows)


def test_few_vectors_and_none(spark):
    rows = [(3, np.ones(64), 0), (4, -np.ones(64), 0)]
    assert sorted(tuple(r) for r in sort_means.sort_means(vectors(spark, rows)).collect()) == plain_clusters(rows)
    assert sort_means.sort_means(vectors(spark, [])).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sort_means.sort_means(vectors(spark, [(3, None, 0)])).count() == 0
    nameless = sort_means.sort_means(vectors(spark, [*rows, (None, np.ones(64), 0)])).where("vec_id is null").collect()
    assert [r["distance"] for r in nameless] == [0]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 30), st.integers(0, 10_000))
def test_scan_from_any_last_centroid_finds_the_nearest(k, n, seed):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-3, 4, (n, 2)), rng.integers(-3, 4, (k, 2))
    best, distance = sort_means.nearest(x, rng.integers(0, k, n), c)
    every = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert best.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()


# byte-level BPE

@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path(byte_bpe.VOCABULARY), "rb") as f:
        return byte_bpe.read_ranks(f.read())


@pytest.fixture(scope="module")
def plain_coder(ranks):
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder(ranks):
    return byte_bpe.Coder(byte_bpe.model_of(ranks), sorted(ranks.values()), public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text("ab \n'st<|endoftext|>9é中\x00\x1c　"), st.lists(st.sampled_from(["the ", "don't", "  ", "\n\n", "ÅÅ", "🙂", "𐍈", "́", "12345", "<unk>", "<s>", "▁"])).map("".join)))
def test_ids_are_those_of_the_plain_coder_and_come_back(coder, plain_coder, text):
    ids = coder.encode(text)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == plain_coder.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


def test_long_texts_and_forgotten_words(coder, plain_coder, monkeypatch):
    monkeypatch.setattr(byte_bpe, "RUN", 40)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 20)
    rng = np.random.default_rng(9)
    text = "x" * 3000 + " " * 500 + " ".join("".join(rng.choice(list("abcdé中"), 5)) for _ in range(3000))
    ids = coder.encode(text)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == plain_coder.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


def test_a_token_that_no_merge_leads_to_is_its_own_id():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300}
    coder = byte_bpe.Coder(byte_bpe.model_of(ranks), sorted(ranks.values()), r"\w+|\W+")
    want = tiktoken.Encoding("gap", pat_str=r"\w+|\W+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abc", "abcd", "abc abc"):
        ids = coder.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want.encode_ordinary(text) and coder.decode(ids) == text.encode()


def test_every_document_as_the_plain_coder_has_it(spark, plain_coder):
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = byte_bpe.op13_byte_bpe(spark, SF).collect()
    assert len(got) == len(text)
    for r in got:
        ids = plain_coder.encode_ordinary(text[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text[r["doc_id"]].encode()).hexdigest())


def test_rows_without_text_or_id(spark):
    docs = spark.createDataFrame([(1, None), (None, "a b"), (2, ""), (3, "a b"), (3, "a b"), (2 ** 62 + 1, "a b")], "doc_id long, text string")
    make = byte_bpe.coder_maker(spark)
    got = byte_bpe.decoded(byte_bpe.encoded(with_clashes(docs), make), make).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["bytes"])) for r in got) == [(0, b"a b"), (1, b""), (2, b""), (3, b"a b"), (3, b"a b"), (2 ** 62 + 1, b"a b")]
    assert byte_bpe.encoded(docs.where("false"), make).count() == 0
