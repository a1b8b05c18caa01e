"""Main text of web pages by wrapper induction over the pages of a host.

The pages of a host are matched with one of them by simple tree matching, and
vote on its nodes: a block that nearly all of them have is template, and the
node under which most of their varying text stands is the slot of the content.
What tags, roles and classes say decides only inside that slot (comments and
adverts vary too), and on pages that no wrapper fits.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.staging import map_rows, prepare, staged, table

#: A block is template where so many pages that differ elsewhere, and such a share of them, have it in the same node.
LEAST_PAGES, SHARE = 3, 0.9
#: The content's slot is the deepest node with this share of what varies on the pages of a host.
SLOT_SHARE = 0.6
#: Siblings of one signature are matched within so many places of each other.
BAND = 32
#: Host wrappers up to so many bytes are broadcast; more are joined by host.
BROADCAST_BYTES = 16_000_000

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_RAW = frozenset(("script", "style", "noscript", "textarea", "title", "iframe", "svg", "template", "select"))
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var
math mrow mi mo mn ms mtext mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mpadded mphantom semantics audio video canvas object picture""".split())
_BOILER_TAGS = frozenset(("nav", "footer", "aside", "form", "button", "menu", "dialog", "head", "fieldset"))
_BOILER_WORDS = frozenset("""ad ads advert advertisement advertising adverts sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs
sidebar footer masthead topbar cookie cookies notice consent gdpr newsletter subscribe subscription signup login comment comments respond reply replies discussion disqus
share sharing social related recommended popup modal overlay pagination pager widget toolbar skip copyright""".split())
_BOILER_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar"))
#: Siblings of one of these tags and one signature are one node, a repeated slot.
_REPEATED = frozenset(("p", "li", "tr", "td", "th", "dt", "dd", "option"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_CLOSED_BY = {"p": frozenset(("p",)), "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")), "option": frozenset(("option",))}


@dataclass
class Node:
    """A block element; a list's items, or the paragraphs of an element, are one node, a repeated slot."""

    name: str
    tag: str
    parent: Node | None
    index: int
    boiler: bool
    article: bool
    header: bool = False
    repeated: dict[str, Node] = field(default_factory=dict)
    blocks: list[tuple[str, int]] = field(default_factory=list)  # text, characters of it in links


@dataclass
class Page:
    nodes: list[Node]
    order: list[tuple[int, int]]  # (node, block) in page order

    def skeleton(self) -> tuple[tuple[int, str], ...]:
        """Parent and signature of each node, parents first."""
        return tuple((n.parent.index if n.parent else -1, n.name) for n in self.nodes)

    def blocks(self) -> list[list[int]]:
        """A hash of each block's text, by node."""
        return [[block_hash(t) for t, _ in n.blocks] for n in self.nodes]

    def weights(self) -> list[list[int]]:
        """Characters outside links of each block, by node; none where tags or classes say that it is no content."""
        return [[0 if n.boiler else max(0, len(t) - linked) for t, linked in n.blocks] for n in self.nodes]


def block_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


@lru_cache(maxsize=20_000)
def _marks(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """Signature of an element, whether its tag, class, id or role says that it is no content, that it is the article, and that it is a header."""
    names, boiler, article, header = [], tag in _BOILER_TAGS, tag in ("article", "main"), tag == "header"
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            words = {w.lower() for w in _PIECE.findall(value)}
            boiler |= bool(words & _BOILER_WORDS)
            header |= "header" in words
            article |= tag in ("div", "section") and bool(words & {"article", "post", "entry", "story"}) and not words & {"list", "meta", "info"}
            names.append(re.sub(r"[0-9]+", "9", value.strip().lower()))
        elif key == "role":
            boiler |= value.lower() in _BOILER_ROLES
            names.append(f"role-{value.lower()}")
            article |= value.lower() in ("main", "article")
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            boiler = True
            names.append("hidden")
    return ".".join([tag, *names]), boiler, article and not boiler, header


def parse(source: str) -> Page:
    """The page's block elements and their texts; tolerates missing end tags and a page cut short."""
    root = Node("", "", None, 0, False, False)
    nodes, order, stack = [root], [], [(root, "")]
    text: list[str] = []
    linked = at = in_link = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if words:
                top = stack[-1][0]
                order.append((top.index, len(top.blocks)))
                top.blocks.append((words, linked))
        linked = 0

    end = len(source)
    while at < end:
        m = _TOKEN.search(source, at)
        piece = source[at:m.start() if m else end]
        if piece:
            text.append(piece)
            linked += len(piece) * bool(in_link)
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                text.append(html.escape(m[0][9:-3]))
            continue
        tag, closing = name.lower(), bool(m[1] or m[4])
        if tag in _RAW:
            if not closing and not (m[0].endswith("/>")):
                stop = re.compile(f"</{tag}[^>]*>", re.IGNORECASE).search(source, at)
                at = stop.end() if stop else end
            continue
        if tag in _INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            continue
        if tag in _VOID:
            if tag in ("br", "hr", "wbr"):
                text.append(" " if tag != "wbr" else "")
            continue
        flush()
        if closing:
            in_link = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][1] == tag:
                    del stack[i:]
                    break
            continue
        closes = _CLOSED_BY.get(tag, frozenset(("p",)))
        while len(stack) > 1 and stack[-1][1] in closes:
            stack.pop()
        above = stack[-1][0]
        signature, boiler, article, header = _marks(tag, m[3] or m[6] or "")
        boiler = above.boiler or boiler or (header and not above.article)
        node = above.repeated.get(signature)
        if node is None:
            node = Node(signature, tag, above, len(nodes), boiler, not boiler and (above.article or article), above.header or header)
            nodes.append(node)
            if tag in _REPEATED:
                above.repeated[signature] = node
        stack.append((node, tag))
    flush()
    return Page(nodes, order)


@lru_cache(maxsize=4096)
def simple_tree_matching(a: tuple[tuple[int, str], ...], b: tuple[tuple[int, str], ...]) -> dict[int, int]:
    """Nodes of ``a`` by those of ``b`` that they are matched with in a largest top-down matching that keeps order and signatures.

    Pairs of nodes are listed from the roots down and weighed from the last
    back, so a deep page needs no deep stack. Siblings of one signature are
    paired up to ``BAND`` places apart, so a long list takes no square of its length.
    """
    if not a or not b or a[0][1] != b[0][1]:
        return {}
    kids_a, kids_b = _children(a), _children(b)
    pairs, below = [(0, 0)], []
    for x, y in pairs:  # grows as it is read
        first = len(pairs)
        named: dict[str, list[int]] = {}
        for v in kids_b[y]:
            named.setdefault(b[v][1], []).append(v)
        seen: dict[str, int] = {}
        for u in kids_a[x]:
            same, at = named.get(a[u][1], []), seen.get(a[u][1], 0)
            seen[a[u][1]] = at + 1
            pairs.extend((u, v) for v in same[max(0, at - BAND):at + BAND + 1])
        below.append((first, len(pairs)))
    weight, chosen = [1] * len(pairs), [()] * len(pairs)
    for i in range(len(pairs) - 1, -1, -1):
        first, last = below[i]
        if first < last:
            total, chosen[i] = _heaviest([(*pairs[j], weight[j], j) for j in range(first, last)])
            weight[i] += total
    out, todo = {}, [0]
    while todo:
        i = todo.pop()
        out[pairs[i][0]] = pairs[i][1]
        todo += chosen[i]
    return out


def _heaviest(pairs: list[tuple[int, int, int, int]]) -> tuple[int, list[int]]:
    """The heaviest choice of pairs ``(x, y, weight, number)`` that rises strictly on both sides: its weight and numbers."""
    places = {y: i + 1 for i, y in enumerate(sorted({y for _, y, _, _ in pairs}))}
    best = [(0, -1)] * (len(places) + 1)  # of the prefixes of places, as a binary indexed tree
    back: list[int] = []
    sums: list[int] = []
    waiting: list[tuple[int, int]] = []
    at_x = None
    for k, (x, y, w, _) in enumerate(pairs):
        if x != at_x:
            _enter(best, waiting, sums)
            waiting, at_x = [], x
        i, found = places[y] - 1, (0, -1)
        while i > 0:
            found = max(found, best[i])
            i -= i & -i
        sums.append(found[0] + w)
        back.append(found[1])
        waiting.append((places[y], k))
    _enter(best, waiting, sums)
    k = max(range(len(pairs)), key=lambda k: (sums[k], -k))
    total, out = sums[k], []
    while k >= 0:
        out.append(pairs[k][3])
        k = back[k]
    return total, out


def _enter(best: list[tuple[int, int]], waiting: list[tuple[int, int]], sums: list[int]) -> None:
    for i, k in waiting:
        while i < len(best):
            best[i] = max(best[i], (sums[k], k))
            i += i & -i


def _children(skeleton: tuple[tuple[int, str], ...]) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in skeleton]
    for i, (parent, _) in enumerate(skeleton):
        if parent >= 0:
            out[parent].append(i)
    return out


def _written(skeleton: tuple[tuple[int, str], ...]) -> str:
    return "\n".join(f"{p} {n}" for p, n in skeleton)


@lru_cache(maxsize=4096)
def _read(skeleton: str) -> tuple[tuple[int, str], ...]:
    return tuple((int(p), n) for p, n in (line.split(" ", 1) for line in skeleton.split("\n")))


def main_text(page: Page, slot: int | None = None, template: frozenset[tuple[int, int]] = frozenset()) -> str:
    """The content of a page: its blocks in page order, joined by spaces.

    ``slot`` is the node that holds the content, as the host's wrapper has it,
    and ``template`` the ``(node, block hash)`` that all its pages have. Without
    a slot, content stands in the article, where the page marks one. Inside
    either, no block counts that stands under an element which is none by its
    tag, class, id or role, nor what an article's own header has beside its
    headings; where neither a slot nor an article is known, no block outside a
    paragraph that is nothing but links either.
    """
    inside = [slot is None or n.index == slot for n in page.nodes]
    for n in page.nodes[1:]:
        inside[n.index] |= inside[n.parent.index]
    article = slot is None and any(n.article and n.blocks for n in page.nodes)
    out = []
    for i, k in page.order:
        n = page.nodes[i]
        words, linked = n.blocks[k]
        if not inside[i] or n.boiler or (article and not n.article) or (i, block_hash(words)) in template:
            continue
        if n.tag not in _HEADINGS and (n.header if n.article else slot is None and n.tag != "p" and linked + words.count(" ") >= len(words)):
            continue
        out.append(words)
    return " ".join(out)


def _outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for page_id, source in zip(pdf["page_id"], pdf["html"], strict=True):
            page = parse(source if isinstance(source, str) else "")
            rows.append((page_id, _written(page.skeleton()), page.blocks(), page.weights()))
        out = pd.DataFrame(rows, columns=["page_id", "skeleton", "blocks", "weights"])
        yield out.assign(host=pdf["host"].array)[["host", "page_id", "skeleton", "blocks", "weights"]]


def votes_of(own: tuple, blocks: list[list[int]], weights: list[list[int]], theirs: tuple, reference: list[list[int]]) -> list[tuple[int, int | None, int, int, int]]:
    """What a page says of its host's reference: ``(node, block, pages, pages with the block, varying characters)``.

    There is a row without a block for each node of the reference that is
    matched, with what stands in the page's node, and in the nodes below that
    are matched with none, and not in the reference's; and one for each block of
    the reference. A page that differs nowhere has no vote.
    """
    pairs = simple_tree_matching(own, theirs)
    have = [set(r) for r in reference]
    home, varies = {}, {}
    same: dict[int, set[int]] = {}
    differs = len(pairs) < max(len(own), len(theirs))
    for x, (parent, _) in enumerate(own):
        y = home[x] = pairs.get(x, home.get(parent, 0))
        known = have[y] if x in pairs else set()
        varies[y] = varies.get(y, 0) + sum(w for h, w in zip(blocks[x], weights[x], strict=True) if h not in known)
        if x in pairs:
            same[y] = set(blocks[x])
            differs |= same[y] != have[y]
    if not differs:
        return []
    return [(y, None, 1, 0, n) for y, n in varies.items()] + [(y, h, 1, int(h in same.get(y, ())), 0) for y, hs in enumerate(have) for h in hs]


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for host, own, blocks, weights, theirs, reference in zip(pdf["host"], pdf["skeleton"], pdf["blocks"], pdf["weights"], pdf["ref_skeleton"], pdf["ref_blocks"], strict=True):
            rows += [(host, *v) for v in votes_of(_read(own), blocks, weights, _read(theirs), reference)]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        names = ("host", "node", "block", "pages", "same", "varying")
        # block hashes stay whole beside the nulls
        yield pd.DataFrame({n: pd.Series(c, dtype="Int64" if n == "block" else object if n == "host" else "int64") for n, c in zip(names, columns, strict=True)})


def slot_of(skeleton: tuple[tuple[int, str], ...], varying: dict[int, int]) -> int | None:
    """The deepest node under which ``SLOT_SHARE`` of the varying text stands, of those that hold elements; none where nothing varies.

    A node that has a varying heading beside the one that would be next is the slot itself.
    """
    total = [varying.get(i, 0) for i in range(len(skeleton))]
    own = list(total)
    for i in range(len(skeleton) - 1, 0, -1):
        total[skeleton[i][0]] += total[i]
    if not total or not total[0]:
        return None
    kids = _children(skeleton)
    at = 0
    while kids[at]:
        ahead = max(kids[at], key=lambda k: (total[k], -k))
        titled = any(own[k] and k != ahead and skeleton[k][1].split(".")[0] in _HEADINGS for k in kids[at])
        if titled or total[ahead] < SLOT_SHARE * total[0] or (2 * own[ahead] >= total[ahead] and skeleton[ahead][1].split(".")[0] in _REPEATED | _HEADINGS):
            break
        at = ahead
    return at


def _choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        slots = [slot_of(_read(skeleton), {v["node"]: v["varying"] for v in varying}) for skeleton, varying in zip(pdf["ref_skeleton"], pdf["varying"], strict=True)]
        yield pdf[["host", "ref_skeleton"]].assign(slot=pd.array(slots, dtype="Int64"))


def wrappers(pages: DataFrame) -> DataFrame:
    """Wrapper of each host: the skeleton of its reference page (its least by a hash of the id), the content's slot in it, and the blocks that are template.

    Every page of a host is matched with its reference by `simple_tree_matching`
    and votes (`votes_of`). Votes are added up before the shuffle, so a host with
    many pages costs no task of its own. Copies of the reference have no vote,
    and a host of fewer than ``LEAST_PAGES`` others has no wrapper.
    """
    outlines = staged(map_rows(pages.select("host", "page_id", "html"), _outline, "host string, page_id long, skeleton string, blocks array<array<long>>, weights array<array<int>>", ("page_id",)))
    refs = staged(outlines.groupBy("host").agg(F.min_by(F.struct("skeleton", "blocks"), F.struct(F.xxhash64("page_id"), "page_id", "blocks")).alias("ref")).select("host", F.col("ref.skeleton").alias("ref_skeleton"), F.col("ref.blocks").alias("ref_blocks")))
    cast = outlines.join(refs, "host").mapInPandas(_compare, "host string, node int, block long, pages long, same long, varying long")
    votes = staged(cast.groupBy("host", "node", "block").agg(F.sum("pages").alias("pages"), F.sum("same").alias("same"), F.sum("varying").alias("varying")))
    # at most the reference's nodes, and its blocks
    varying = votes.where("block is null").groupBy("host").agg(F.collect_list(F.struct("node", "varying")).alias("varying"), F.max("pages").alias("pages")).where(F.col("pages") >= LEAST_PAGES).drop("pages")
    constant = votes.where(F.col("block").isNotNull() & (F.col("pages") >= LEAST_PAGES) & (F.col("same") >= SHARE * F.col("pages"))).groupBy("host").agg(F.array_sort(F.collect_list(F.struct("node", "block"))).alias("template"))
    found = refs.select("host", "ref_skeleton").join(varying, "host").mapInPandas(_choose, "host string, ref_skeleton string, slot int")
    return staged(found.join(constant, "host", "left").select("host", "ref_skeleton", "slot", F.coalesce("template", F.array().cast("array<struct<node:int,block:bigint>>")).alias("template")))


def _extract(source: str | None, wrapper) -> str:
    page = parse(source if isinstance(source, str) else "")
    if wrapper is not None:
        skeleton, slot, constant = wrapper
        back = {y: x for x, y in simple_tree_matching(page.skeleton(), _read(skeleton)).items()}
        template = frozenset((back[y], h) for y, h in constant if y in back)
        text = main_text(page, back[slot], template) if slot is not None and slot in back else ""
        if text:
            return text
        return main_text(page, None, template)
    return main_text(page)


def _result(pdf: pd.DataFrame, texts: list[str]) -> pd.DataFrame:
    return pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every page: ``page_id``, ``url``, ``text``, ``n_chars``.

    Takes ``page_id``, ``url`` and ``html``; other columns are ignored. Pages are
    grouped by the host in their url; those without a url are a group. A page
    gets what varies in the content's slot of its host's wrapper; one that has
    no such slot, or nothing in it, and one of a host without a wrapper, is
    read by its tags, roles and classes alone (`main_text`). Wrappers are
    broadcast while they are small, and joined by host beyond that. A null or
    empty html, or one without content, gives the empty text. Pages may be as
    deep, as wide and as long as they like. Repeated rows stay; an empty table
    gives no rows.
    """
    spark = pages.sparkSession
    prepare(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").cast("string").alias("html"), F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit(""))).alias("host"))
    found = wrappers(rows)
    schema = "page_id long, url string, text string, n_chars long"
    size = found.agg(F.coalesce(F.sum(F.length("ref_skeleton") + F.size("template") * 16 + F.length("host") + 100), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        sent = spark.sparkContext.broadcast({r["host"]: (r["ref_skeleton"], r["slot"], [tuple(t) for t in r["template"]]) for r in found.collect()})

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield _result(pdf, [_extract(h, sent.value.get(host)) for h, host in zip(pdf["html"], pdf["host"], strict=True)])

        return map_rows(rows, run, schema, ("page_id",))

    def run_joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _result(pdf, [_extract(h, (s, None if pd.isna(slot) else int(slot), [(v["node"], v["block"]) for v in t]) if isinstance(s, str) else None) for h, s, slot, t in zip(pdf["html"], pdf["ref_skeleton"], pdf["slot"], pdf["template"], strict=True)])

    return map_rows(rows.join(found, "host", "left"), run_joined, schema, ("page_id",))


def op9_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
