"""Sizes, scripts and skews at which the operators once behaved otherwise."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import contamination, fingerprints, licenses, near_dup, pages, personal_data, quality, secrets, shards
from tests.llm.test_corpus import DOCS, rows, shingle_set, table


# contamination

@pytest.mark.parametrize("size", [1, 2, 7, 63, 64, 239, 240, 300, 1000])
def test_no_shingles_that_may_be_missing_hide_a_long_item(size):
    item = [f"w{i}" for i in range(size + 4)]
    index = contamination.build_index([1], [" ".join(item)], 0.8)
    assert index.sizes[0] == size and index.needed[0] >= min(contamination.SKETCH, -(-size * 4 // 5))
    lost = {int(h) for h in index.sketch[:size // 5]}  # the worst document: all that it may lack is in the sketch
    kept = [h for h in index.sets.tolist() if h not in lost]
    assert len(kept) >= 0.8 * size and len(set(index.sketch.tolist()) & set(kept)) >= index.needed[0]


def test_items_of_all_sizes_are_found_as_by_brute_force():
    rng = np.random.default_rng(1)
    items = [" ".join(rng.choice([f"v{i}" for i in range(500)], n)) for n in (3, 5, 8, 30, 70, 250, 304, 900)]
    docs = []
    for item in items:
        for share in (0.02, 0.06, 0.3):
            words = item.split()
            for at in rng.choice(len(words), max(0, int(share * len(words))), replace=False):
                words[at] = f"new{at}"
            docs.append(" ".join(["a", "b", "c", *words, "d"]))
    index = contamination.build_index(list(range(len(items))), items, 0.8)
    got = {(i, k) for i, k, _, _ in contamination.find_items(index, docs, 0.8)}
    want = {(i, k) for i, d in enumerate(docs) for k, t in enumerate(items) if len(shingle_set(t) & (shingle_set(d) | ({tuple(t.split())} if t in d else set()))) >= 0.8 * len(shingle_set(t))}
    assert got == want and len(want) > 12


def test_blocks_of_items_are_bounded_by_characters_not_by_ids(spark, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_CHARS", 400)
    texts = [" ".join(f"t{i}x{j}" for j in range(12)) for i in range(20)]
    items = spark.createDataFrame([(7, t) for t in texts], "item_id long, text string")
    got = contamination.contaminated(table(spark, texts), items).groupBy("doc_id").count().collect()
    assert {(r["doc_id"], r["count"]) for r in got} == {(i, 1) for i in range(20)}


# secrets

def test_offsets_of_many_matches_and_what_they_cover(spark):
    text = " ".join(f"secret=abcdef{i:05d} filler" for i in range(3000)) + " " + " ".join("Zq9" * 8 for _ in range(300))
    got = secrets.secrets(table(spark, [text])).collect()[0]
    want = [(m.start(), 0, m.end()) for m in re.finditer(r"secret=\w+", text)]
    assert [tuple(s) for s in got["base"]] == want and len(want) == 3000
    df = spark.createDataFrame([([5, 0, 2, 7],), ([],), ([3],)], "v array<int>").select(secrets.before(F.col("v")).alias("b")).collect()
    assert [r["b"] for r in df] == [[0, 5, 5, 7], [], [0]]


@settings(deadline=None, max_examples=30, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), max_size=8), st.lists(st.integers(1, 6), max_size=8))
def test_tokens_apart_from_spans(spark, spans, steps):
    tokens, at = [], 0
    for n in steps:
        tokens.append((at + n % 3, at + n % 3 + n))
        at += n % 3 + n
    df = spark.createDataFrame([([(a, b) for a, b in tokens], [(a, a + n) for a, n in spans])], "t array<struct<start:int,end:int>>, s array<struct<start:int,end:int>>")
    got = df.select(secrets.apart(F.col("t"), F.col("s")).alias("k")).collect()[0]["k"]
    assert [tuple(k) for k in got] == [(a, b) for a, b in tokens if all(b <= x or a >= x + n for x, n in spans)]


def plain_p(token, alphabet):
    codes = np.array([alphabet.index(c) + 1 for c in token], float)
    k, n = len(alphabet), len(token)
    chi = ((np.bincount(codes.astype(int), minlength=k + 1)[1:] - n / k) ** 2 / (n / k)).sum()
    z = [((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))]
    changes = int(((codes[1:] > k / 2) != (codes[:-1] > k / 2)).sum())
    z.append(abs(changes - (n - 1) / 2) / (math.sqrt(n - 1) / 2))
    x = codes - codes.mean()
    serial = ((codes[1:] * codes[:-1]).sum() / (n - 1) - codes.mean() ** 2) / max((x ** 2).mean(), 1e-9)
    z.append(abs(serial + 1 / (n - 1)) * math.sqrt(n))
    tail = [max(1e-300, math.erfc(v / math.sqrt(2)) / 2) for v in z]
    half = -(math.log(tail[0]) + math.log(min(1, 2 * tail[1])) + math.log(min(1, 2 * tail[2])))
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def test_the_three_tests_against_a_plain_computation(spark):
    rng = np.random.default_rng(2)
    data = [(i, "".join(rng.choice(list(letters), int(n)))) for i, (_, letters) in enumerate(secrets.ENCODINGS) for n in (20, 33, 80)]
    df = spark.createDataFrame(data, "encoding int, token string")
    for r in secrets.randomness(df).collect():
        assert abs(r["p"] - plain_p(r["token"], secrets.ENCODINGS[r["encoding"]][1])) < 1e-4


def test_random_small_letters_are_found_and_words_are_not(spark):
    rng = np.random.default_rng(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["internationalisationsbestrebungen", "Donaudampfschifffahrtsgesellschaft", "counterrevolutionaryestablishment", "unveroeffentlichungsgenehmigungen"] * 20
    keys = ["".join(rng.choice(list(letters), 40)) for _ in range(80)] + ["".join(rng.choice(list(letters.upper() + letters + "+/-_"), 40)) for _ in range(40)]
    got = rows(secrets.secrets(table(spark, [f"x {t} y" for t in keys + words])))
    found = [any(s["kind"] == 3 for s in got[i]["spans"]) for i in range(200)]
    assert sum(found[:80]) >= 70 and sum(found[80:120]) >= 33 and sum(found[120:]) <= 4


# fingerprints

def plain_pieces(text):
    out = []
    for run in re.findall(r"[^\t\n\x0b\f\r ]+", text):
        at = 0
        while at < len(run):
            step = 1 if "一" <= run[at] <= "鿿" or at >= fingerprints.RUN else next(n for n in range(1, 5) if at + n >= len(run) or n == 4 or "一" <= run[at + n] <= "鿿" or at + n >= fingerprints.RUN)
            out.append(run[at:at + step])
            at += step
    return out


def test_syncmers_by_brute_force(spark):
    rng = np.random.default_rng(6)
    letters = list("abcde fgh 漢字仮名 ")
    texts = ["".join(rng.choice(letters, n)) for n in (0, 1, 2, 5, 9, 30, 400, 401, 900)] + ["q" * 100 + "z", "x", "a b", " \t "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    hashed = {r["w"]: r["h"] for r in df.select(F.explode(F.lit([w for t in texts for w in plain_pieces(t)] + ["none"])).alias("w")).distinct().select("w", F.hash("w").alias("h")).collect()}
    got = {r["i"]: r for r in df.select("i", fingerprints.pieces(F.col("t")).alias("p"), fingerprints.anchors(F.col("t")).alias("a")).collect()}
    many, ends = fingerprints.MANY, fingerprints.ENDS
    marks = spark.range(1).select(F.hash(F.lit(1)), F.hash(F.lit(2))).first()
    asked = [(i, k, a, b) for i, t in enumerate(texts) for k, (a, b) in enumerate(zip([marks[0], *[hashed[w] for w in plain_pieces(t)]], [*[hashed[w] for w in plain_pieces(t)], marks[1]], strict=True)) if plain_pieces(t)]
    pairs: dict[int, list[int]] = {}
    for r in spark.createDataFrame(asked, "i int, k int, a int, b int").select("i", "k", F.hash("a", "b").alias("h")).orderBy("i", "k").collect():
        pairs.setdefault(r["i"], []).append(r["h"])
    for i, t in enumerate(texts):
        assert got[i]["p"] == plain_pieces(t)
        top = [2 ** 31 - 1] * (ends - 1)
        p = top + pairs.get(i, []) + top
        want = [k - ends for k in range(len(p) - many + 1) if min(p[k], p[k + many - 1]) == min(p[k:k + many])] if i in pairs else []
        assert [s["pos"] for s in got[i]["a"]] == (want if i in pairs else [-ends] * bool(t)) and (not t or got[i]["a"])


def test_likeness_at_all_lengths_and_scripts(spark):
    rng = np.random.default_rng(5)
    han = lambda n: "".join(chr(c) for c in rng.integers(0x4E00, 0x9FA0, n))
    prose = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n))
    first, long, short = han(600), prose(600), prose(90)
    pairs = [(han(600), han(600), 0, 0.05), (first, "前" + first, 0.95, 1), (long, "some more words " + long, 0.95, 1), (short[:398], short[:401], 0.85, 1), (short[:31], short[:34], 0, 1), ("", "", 1, 1), ("", "a", 0, 0), ("a", "b", 0, 0), (" ", "\t\t", 0, 0), (long, prose(600), 0, 0.05), (long, long[:2000] + prose(300), 0.4, 0.8)]
    token = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 5000))
    pairs += [(token, "zz" + token, 0.95, 1), (token, token[::-1], 0, 0.05)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _, _) in enumerate(pairs)], "i int, a string, b string")
    got = df.select("i", fingerprints.packed_anchors(F.col("a")).alias("a"), fingerprints.packed_anchors(F.col("b")).alias("b")).select("i", fingerprints.likeness(F.col("a"), F.col("b")).alias("x"), fingerprints.likeness(F.col("b"), F.col("a")).alias("y"), fingerprints.matches(F.col("a"), F.col("b")).alias("m"))
    for r in got.collect():
        assert pairs[r["i"]][2] <= r["x"] <= pairs[r["i"]][3] and abs(r["x"] - r["y"]) < 0.05, (pairs[r["i"]][0][:30], r["x"])
        if r["i"] == 2:
            assert {m["pos_b"] - m["pos_a"] for m in r["m"] if m["pos_a"] >= 0} == {4}


# pages

NEUTRAL = "<html><body><div class=a><div>{nav}</div><div>Our own site since 1990</div></div><div class=b><div class=c><h2>T{i}</h2><p>{first}</p><p>{second}</p><p>" + "This notice stands on every page of the site and is rather long. " * 8 + "</p></div><div class=d>{side}</div></div><div class=e>All of it is ours {i}</div></body></html>"


def prose(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n))


def test_wrappers_find_the_content_without_telling_names(spark):
    rng = np.random.default_rng(9)
    data, want = [], {}
    for i in range(12):
        first, second = prose(rng, 60), prose(rng, 80)
        data.append((i, f"http://n.example.org/{i}", NEUTRAL.format(i=i, nav=prose(rng, 3), side=prose(rng, 4), first=first, second=second)))
        want[i] = f"T{i} {first} {second}"
    source = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extract(source).collect()}
    assert got == want
    assert all(pages.main_text(pages.parse(h)) != want[i] for i, _, h in data)  # the wrapper decides


def test_constant_blocks_among_varying_siblings_are_template(spark):
    page = "<main><p>One {0} of a kind and more</p><p>Read our terms</p><p>Two {0} of another</p></main>"
    source = spark.createDataFrame([(i, "http://c.example.org/x", page.format(i)) for i in range(5)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in pages.extract(source).collect()} == {i: f"One {i} of a kind and more Two {i} of another" for i in range(5)}


def test_copied_articles_stay(spark):
    """A group of copies on a host, and pages that are the same everywhere, are no template."""
    page = "<div class=x><h1>T{0}</h1><p>Story {0} is long and good</p></div>"
    data = [(i, "http://a.example.org/", page.format(0 if i < 4 else i)) for i in range(12)] + [(20 + i, "http://b.example.org/", page.format(7)) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"T{n} Story {n} is long and good" for i, n in [(0, 0), (3, 0), (5, 5), (11, 11), (20, 7), (24, 7)])


def test_deep_and_wide_pages(spark):
    deep, wide = "<div>" * 3000 + "x{0} text" + "</div>" * 3000, "<ul>" + "".join(f"<div class=c>item {i} {{0}}</div><section>b</section>" for i in range(1500)) + "</ul>"
    data = [(i, "http://d.example.org/", deep.format(i)) for i in range(4)] + [(10 + i, "http://w.example.org/", wide.format(i)) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert got[2] == "x2 text" and got[12].startswith("item 0 2 item 1 2")


def plain_matching(a, b):
    """Size of a largest matching, by the textbook recursion."""
    def kids(t, x):
        return [i for i, (p, _) in enumerate(t) if p == x]

    def match(x, y):
        if a[x][1] != b[y][1]:
            return 0
        left, right = kids(a, x), kids(b, y)
        m = np.zeros((len(left) + 1, len(right) + 1), int)
        for i, u in enumerate(left):
            for j, v in enumerate(right):
                m[i + 1, j + 1] = max(m[i, j + 1], m[i + 1, j], m[i, j] + match(u, v))
        return int(m[-1, -1]) + 1
    return match(0, 0)


@settings(deadline=None, max_examples=200)
@given(*[st.lists(st.tuples(st.integers(0, 30), st.sampled_from("xyz")), max_size=9)] * 2)
def test_matching_is_a_largest_one(left, right):
    a, b = (((-1, "r"), *((at % (i + 1), name) for i, (at, name) in enumerate(t))) for t in (left, right))
    got = pages.simple_tree_matching(a, b)
    assert len(got) == plain_matching(a, b) and len(set(got.values())) == len(got)
    assert all(a[x][1] == b[y][1] and (x == 0 or got[a[x][0]] == b[y][0]) for x, y in got.items())
    order = sorted(got)
    assert all(not (a[x][0] == a[u][0] and got[x] > got[u]) for i, x in enumerate(order) for u in order[i + 1:])


# licences

def plain_lcs(a, b):
    m = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            m[i + 1, j + 1] = m[i, j] + 1 if x == y else max(m[i, j + 1], m[i + 1, j])
    return int(m[-1, -1])


def test_notices_over_the_table_by_brute_force(spark):
    """Every stretch of every text that has the words of a one-sentence notice in order, by a longest common subsequence."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r["doc_id"]: set(r["licenses"].split(",")) - {""} for r in licenses.license_notices(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()}
    short = [(n, re.findall(r"\w+", t.lower())) for n, t in licenses.TEMPLATES if len(t) < 90]
    found = 0
    for i, text in docs.items():
        words = re.findall(r"\w+", text.lower())
        want = set()
        for name, t in short:
            names = set(licenses.NAMES[name].split()) & set(t)
            size = int(1.5 * len(t)) + 2
            for at in range(len(words)):
                stretch = words[at:at + size]
                if stretch[0] in t and names <= set(stretch) and plain_lcs(stretch, t) >= 0.8 * len(t):
                    want.add(name)
        found += bool(want)
        assert bool(got[i]) == bool(want) and got[i] <= want, i
    assert found > 3


@pytest.mark.parametrize(("text", "want"), [
    ("it is offered under CC BY 4.0 to all", ["CC-BY-4.0"]), ("Licensed under CC BY-NC-SA 4.0", ["CC-BY-NC-SA-4.0"]), ("licensed under the BSD License.", []),
    ("all rights reserved. All Rights Reserved", ["All-rights-reserved"] * 2), ("Released under MIT License", ["MIT"]), ("the rights of all are reserved here", []),
    (licenses.TEMPLATES[-6][1] + " " + licenses.TEMPLATES[-2][1], ["MIT", "Zlib"]), (licenses.TEMPLATES[-4][1].replace("contributors", "members").upper(), ["BSD-3-Clause"]),
])
def test_notices_without_telling_words_and_whole_licences(text, want):
    assert [n for _, _, n, _ in licenses.notices(text)] == want


# personal data

#: Lines that are not in the labelled table.
HELD_OUT = (
    "please call {phone 0711 4567890} tomorrow",
    "phone {phone 069 7654321} after ten",
    "dial {phone (040) 765-4321} for help",
    "tel {phone 555-867-5309} is hers",
    "call {phone 030 7654321}",
    "ring {phone 01 44 55 66 77} today",
    "her mobile {phone 0160-555-0111} is off",
    "mail {email karl at firm.example.net} now",
    "write to {email ann (at) lake (dot) net} soon",
    "send it to {email eva [at] example [dot] org}",
    "{email rob at sea.example.com}",
    "reach {email admin@gateway} first",
    "host {ip 2001:db8::42} is up",
    "from {ip fe80:0:0:0:1:2:3:4} it came",
    "card {card 4012-8888.8888 1881} was lost",
    "pay with {card 5105.1051.0510.5100} now",
    "in 2021 we had 14 of 20",
    "on 12.05.2021 at 10.30 we met",
    "we sold 200 000 copies by 2005",
    "order 991234 and item 12 came",
    "chapter 12 verse 8 of it",
    "look at example.net tomorrow",
    "the ratio is 4:3 or 21:9",
    "from 1900 to 1950 it stood",
    "he went at 5 and came at 6",
    "ask @nobody about it",
)


def test_field_on_held_out_lines():
    """Whole spans of lines that the field was not trained on: precision and recall."""
    lines, want = [], []
    for line in HELD_OUT:
        m = re.search(r"\{(\w+) ([^}]*)\}", line)
        lines.append(re.sub(r"\{\w+ ([^}]*)\}", r"\1", line))
        want.append([(m.start(), m.start() + len(m[2]), m[1])] if m else [])
    got = [[s for s in all_ if s not in base] for base, all_ in personal_data.all_spans(lines, personal_data.trained())]
    right = sum(s in w for g, w in zip(got, want, strict=True) for s in g)
    assert right / max(1, sum(map(len, got))) >= 0.9 and right / sum(map(len, want)) >= 0.8, [(x, g) for x, g, w in zip(lines, got, want, strict=True) if g != w]


def test_viterbi_over_lines_of_all_lengths_by_all_paths():
    crf, rng = personal_data.trained(), np.random.default_rng(1)
    lines = [np.stack([rng.integers(0, c, n) for c in crf.cards], axis=1) for n in (1, 2, 3, 4, 5, 5)]
    for feats, path in zip(lines, crf.decode(lines), strict=True):
        s, many = crf.scores(feats), len(personal_data.LABELS)
        value = lambda p: sum(s[i, x] for i, x in enumerate(p)) + sum(crf.move[x, y] for x, y in zip(p, p[1:], strict=False))
        best = max(value([code // many ** i % many for i in range(len(s))]) for code in range(many ** len(s)))
        assert abs(value(path.tolist()) - best) < 1e-9


def test_long_words_and_lines_are_not_cut():
    crf = personal_data.trained()
    word = "x" * 5000
    assert personal_data._word_features(word + "1")[1] != personal_data._word_features(word + "@1")[1]
    text = " ".join(["filler"] * 20_000) + " call 030 1234567"
    assert personal_data.model_spans([text], crf)[0] == [(len(text) - 11, len(text), "phone")]


# shards

def test_fewer_links_are_parted_than_by_hash(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    links = docs.select("doc_id", F.sha2("text", 256).alias("group"))
    dealt = spark.createDataFrame(shards.balanced_shards(docs).select("doc_id", "shard").collect(), "doc_id long, shard int")
    cut, whole = shards.parted_links(dealt, links)
    by_hash, _ = shards.parted_links(docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(40)).cast("int").alias("shard")), links)
    assert whole > 0 and cut == 0 and by_hash > 0.9 * whole


def test_groups_stay_whole_where_shards_are_full(spark):
    """Forty groups of a quarter to half a shard in ten shards: no member is parted from its group, and sizes stay near."""
    texts = [f"group {g} " + "x" * 400 for g in range(25) for _ in range(8)] + [f"single {i} " + "y" * (i % 90) for i in range(700)]
    got = shards.balanced_shards(table(spark, texts), 10).collect()
    where, load = {}, {}
    for r in got:
        where.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
    assert all(len(s) == 1 for t, s in where.items()) and max(load.values()) < 1.25 * min(load.values())


def test_requests_of_larger_gain_come_first(spark):
    """Two pairs want one shard that has room for one; the heavier pair's move gains more."""
    ids = {s: [] for s in range(2)}
    for r in spark.range(200).select("id", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).alias("s")).collect():
        ids[r["s"]].append(r["id"])
    items = [(ids[0][0], 50), (ids[1][0], 10), (ids[0][1], 8), (ids[1][1], 7), (ids[0][2], 30)]
    links = [(items[0][0], "big"), (items[1][0], "big"), (items[2][0], "small"), (items[3][0], "small")]
    got = {r["id"]: r["shard"] for r in shards.propagate(spark.createDataFrame(items, "id long, weight long"), spark.createDataFrame([(i, g.encode()) for i, g in links], "id long, group binary"), 2, 100, 1).collect()}
    assert got[items[1][0]] == 0 and got[items[0][0]] == 0 and got[items[3][0]] == 1


# near duplicates, by plain Python alone

def plain_sets(texts):
    """Weighted shingle sets from the documented formulas: words, counts of documents, idf of words, mean over a shingle, damped counts."""
    words = [re.findall(r"[^\W_]+", t.lower()) for t in texts]
    seen = {}
    for w in words:
        for x in set(w):
            seen[x] = seen.get(x, 0) + 1
    rare, top = near_dup.RARE, near_dup.TOP

    def idf(x):
        share = seen[x] / len(texts)
        return 1 + (top - 1) * math.log(1 / min(1, max(rare, share))) / math.log(1 / rare)

    out = []
    for w in words:
        own = {}
        for i in range(max(1, len(w) - 4)) if w else ():
            s = tuple(w[i:i + 5])
            own[s] = own.get(s, 0) + 1
        out.append({s: sum(map(idf, s)) / len(s) * (1 + math.log(n)) for s, n in own.items()})
    return out


def plain_similarity(a, b):
    shared = sum(min(v, b[s]) for s, v in a.items() if s in b)
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def test_groups_are_those_of_all_pairs_by_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = sorted(text)
    sets = dict(zip(ids, plain_sets([text[i] for i in ids]), strict=True))
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    near = 0
    for i in ids:
        for j in ids:
            if i < j and (plain_similarity(sets[i], sets[j]) >= near_dup.THRESHOLD or text[i] == text[j]):
                near += text[i] != text[j]
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(docs).collect()}
    assert near > 0 and got == {i: root(i) for i in ids}


def test_recall_of_pairs_with_two_hundred_documents_outside_the_largest_class(spark):
    """Two hundred groups of two in the buckets of a hot one, and near copies with similarities from 0.8 on: at least nine in ten pairs are found."""
    rng = np.random.default_rng(12)
    vocabulary = [f"v{i}" for i in range(3000)]
    texts = []
    for _ in range(200):
        base = list(rng.choice(vocabulary, 120))
        other = list(base)
        for at in rng.choice(120, int(rng.integers(1, 3)), replace=False):
            other[at] = "new"
        texts += [" ".join(base), " ".join(other)]
    texts += [" ".join(vocabulary[:150])] * 300
    sets = plain_sets(texts)
    want = [(2 * k, 2 * k + 1) for k in range(200) if plain_similarity(sets[2 * k], sets[2 * k + 1]) >= near_dup.THRESHOLD]
    got = {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(table(spark, texts)).collect()}
    assert len(want) > 150 and sum(got[a] == got[b] for a, b in want) >= 0.9 * len(want)
    assert len({got[i] for i in range(400, 700)}) == 1 and all(got[a] != got[a + 2] for a in range(0, 396, 2))


# quality

def test_votes_by_plain_neighbours():
    rng = np.random.default_rng(3)
    labelled, asked = ([" ".join("".join(rng.choice(list("abcXYZ12!|? "), rng.integers(2, 9))) for _ in range(40)) for _ in range(n)] for n in (60, 25))
    labels = rng.integers(0, 2, 60)
    model = quality.fit(quality.counts(labelled), labels)
    own, theirs = (model.place(quality.counts(x)) for x in (asked, labelled))
    for vector, score in zip(own, model.score(quality.counts(asked)), strict=True):
        near = sorted(((float(vector @ v), y) for v, y in zip(theirs, labels, strict=True)), reverse=True)[:quality.NEIGHBOURS]
        weight = [max(c, 0.0) ** quality.SHARPNESS for c, _ in near]
        assert abs(score - sum(w * y for w, (_, y) in zip(weight, near, strict=True)) / sum(weight)) < 1e-4
    together, alone = quality.counts(labelled), np.concatenate([quality.counts([t]) for t in labelled])
    assert np.array_equal(together, alone)


# the pipeline

def test_rows_without_an_id_stay(spark):
    import corpus_pipeline
    docs = spark.createDataFrame([(None, "one text of many words that stands here twice over", "en", "s", 1), (None, "one text of many words that stands here twice over", "en", "s", 1), (1, "x y z", "en", "s", 1)], DOCS)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, "/root/testdata/sf0.001").where("doc_id is null").count() == 2, name


def test_every_address_that_can_hold_is_decoded():
    """What a span may be triggers the field, letters alone as well."""
    for text in ("fe:ab:cd:ef:fe:ab:cd:ef", "FE80::1", "a:b:c:d:e:f:a:b"):
        assert personal_data._holds("ip", text) and personal_data._TRIGGER.search(f"via {text} it went")
