"""Layout of root texts: hand-made frames, a plain reading of text kinds, and that no letter is lost."""

from __future__ import annotations

import random
import re

from lectern.functions import metre
from lectern.operators import roottext

LINE = "ཀ་ཁ་ག་ང་ཅ་ཆ་ཇ། །"
SAID = "བཀའ་སྩལ་ཏོ། །"
PIECES = [LINE, LINE, SAID, "སངས་རྒྱས་ལ་ཕྱག་འཚལ་ལོ། །", "མཁན་པོ་དང་། ", "ལོ་ཙཱ་བས་བསྒྱུར་བའོ། །", "སློབ་དཔོན་གྱིས་མཛད་པ་རྫོགས་སོ། །", "ཨོཾ་སྭཱ་ཧཱ། ", "ཀ་ཞེས་སོ། །", "ཁ་ག་ནས།", "༄༅། །", "\n\n", "\n", "ཀ་ག་ང༔ ", "ག །", "words, too ", "ཁ[^1]། །", "རྒྱ་གར་སྐད་དུ། ", "བོད་སྐད་དུ། "]


def lines(spark, texts, **options):
    df = spark.createDataFrame(list(texts.items()), "k int, text string")
    out: dict = {k: [] for k in texts}
    for r in roottext.laid_out(df, "k", **options).orderBy("k", "line").collect():
        out[r["k"]].append((r["zone"], r["kind"], r["text"]))
    return out


def zone(found, name):
    return [t for z, kind, t in found if z == name and kind != "heading"]


def test_no_letter_is_lost(spark):
    rng = random.Random(5)
    texts = {}
    for k in range(120):
        body = "".join(rng.choice(PIECES) for _ in range(rng.randrange(60)))
        texts[k] = rng.choice(["", "# ཀ་ཁ་ག་ང\n\n", "---\na: b\n---\n# ཀ་ཁ\n"]) + body + rng.choice(["", "\n[^1]: note\n[^2]: other\n"])
    squeezed = lambda t: re.sub(r"\s", "", t)
    for form in ("auto", "verse", "prose"):
        for k, found in lines(spark, texts, form=form).items():
            title = "".join(re.sub(r" \^0$", "", t) for z, _, t in found if z == "title")
            front = "".join(zone(found, "frontmatter"))
            rest = "".join(t for z, kind, t in found if kind != "heading" and z != "frontmatter")
            assert squeezed(front + title + rest) == squeezed(texts[k]), (form, texts[k], found)


def test_paragraphs_and_forms(spark):
    rng = random.Random(8)
    texts = {k: "\n\n".join("".join(rng.choice(PIECES[:9]) for _ in range(rng.randrange(1, 9))) for _ in range(6)) for k in range(40)}
    for form in ("verse", "prose"):
        for k, found in lines(spark, texts, form=form).items():
            for t in zone(found, "body"):
                assert any(re.sub(r"\s", "", t) in re.sub(r"\s", "", p) for p in texts[k].split("\n\n")), "a unit runs across a paragraph"


def plain_kind(text):
    t = re.sub(r"\[\^\d+\]", "", text).replace("༌", "་")
    count = lambda s: len(re.findall("[ཀ-ྼ]+", s))
    total = max(count(t), 1)
    sizes = [count(c) for c in re.split("[།༔]+", t) if count(c)]
    share = sum(n for i, n in enumerate(sizes) if n >= 5 and n in sizes[max(i - 1, 0):i] + sizes[i + 1:i + 2]) / total
    gloss = len(re.findall("ཞེས་པ་(?:ནི|སྟེ|ལ)|ཞེས་བྱ་བ་(?:ནི|ལ)", t)) * 1000 / total
    title = next((x for x in text.split("\n") if x.strip()), "")
    if gloss >= 3 or (share < 0.6 and (gloss >= 1 or re.search("འགྲེལ|རྣམ་པར་བཤད|རྣམ་བཤད", title))):
        return "commentary"
    return "verse" if share >= 0.6 else "prose" if share < 0.3 else "mixed"


def test_kinds(spark):
    rng = random.Random(2)
    heads = ["", "# ཀ་འགྲེལ་པ\n", "# ཀ་ཁ\n"]
    texts = [(k, rng.choice(heads) + "".join(rng.choice([*PIECES[:3], "ཁ་ག་ང་ནས་ཏེ། ", "ཀ་ཞེས་པ་ནི། " if k % 5 == 0 else "ཀ། "]) for _ in range(rng.randrange(1, 30)))) for k in range(150)]
    rows = roottext.text_kind(roottext.parts_of(spark.createDataFrame(texts, "k int, text string"))).select("k", "kind").collect()
    found = {r["k"]: r["kind"] for r in rows}
    assert found == {k: plain_kind(t) for k, t in texts}
    assert set(found.values()) == {"commentary", "verse", "mixed", "prose"}


def test_colophons(spark):
    wrote, turned, scholar = "སློབ་དཔོན་གྱིས་མཛད་པ་རྫོགས་སོ། །", "ལོ་ཙཱ་བ་ཡིས་བསྒྱུར་བའོ། །", "རྒྱ་གར་གྱི་མཁན་པོ་དང་།"
    found = lines(spark, {
        1: LINE * 8 + wrote + LINE * 2,  # verse after it stays with it
        2: LINE * 8 + scholar + "\n\n" + turned,  # a paragraph between scholars and translators
        3: LINE * 8,
        4: f"# མདོ་ཀ་ཁ\n\n{LINE * 8}མདོ་ཀ་ཁ་རྫོགས་སོ། །ང་ཡིས་བྲིས། {turned}",  # the work's own closing line, and no translators next to it: they are told by the rest
    })
    assert zone(found[1], "closing") == [(wrote + LINE * 2).strip()]
    assert zone(found[2], "closing") == [f"{scholar} {turned}"] and len(zone(found[2], "body")) == 8
    assert zone(found[3], "closing") == []
    assert zone(found[4], "body")[-1] == "མདོ་ཀ་ཁ་རྫོགས་སོ། །" and "".join(zone(found[4], "closing")).endswith(turned)


def test_lines_of_a_verse_text():
    of = lambda size, closed, final=(), rubric=(), cut=(): metre.padas(size, closed, [i in final for i in range(len(size))], [i in rubric for i in range(len(size))], [i in cut for i in range(len(size))], 7)
    yes = lambda n: [True] * n
    assert of([7, 7, 7], yes(3)) == [0, 1, 2]
    assert of([7, 7, 3, 2, 7, 7], [True, True, False, False, True, True]) == [0, 1, 2, 2, 3, 4]  # a run
    assert of([7, 7, 3, 2, 7, 7], [True, True, False, False, True, True], cut=[2]) == [0, 1, 2, 3, 4, 5]  # a paragraph in it
    assert of([7, 7, 3, 7, 7, 7], [True, True, False, True, True, True], final=[3]) == [0, 1, 2, 2, 3, 4]  # its label
    assert of([50, 50, 20], [False] * 3) == [0, 1, 1]  # a run that would be too long
    assert of([3, 2, 2], yes(3), rubric=[0]) == [0, 1, 1]
    assert of([9, 9, 7], [True, True, False]) == [0, 1, 2] and of([], []) == []


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n ", "x"), (4, "# ཀ", "x"), (5, "༄༅། །", "x"), (6, LINE, "x"), (6, LINE, "x"), (7, "ཀ" + "།" * 30000 + " " * 30000 + "ཁ།", "x")]
    df = spark.createDataFrame(rows, "k int, text string, kind string")
    parts = spark.createDataFrame([(6, 1, "one", "ཀ་ཁ"), (6, 2, None, None), (9, 1, "none", "ཀ")], "k int, pos int, label string, anchor string")
    found = [(r["k"], r["zone"], r["text"]) for r in roottext.laid_out(df, "k", parts).orderBy("k", "line").collect()]
    assert {k for k, *_ in found} == {4, 5, 6, 7}
    assert found.count((6, "body", "## one ^1-0")) == 2 and found.count((6, "unplaced", None)) == 2
    assert roottext.laid_out(df.where("k > 9"), "k", parts).count() == 0


def test_a_long_work(spark):
    text = "# མདོ་ཀ་ཁ\n\n" + (LINE * 30 + SAID + "\n\n") * 900
    df = spark.createDataFrame([(1, text)], "k int, text string")
    assert roottext.laid_out(df, "k").where("zone = 'body' and kind <> 'heading'").count() == 900 * 31
