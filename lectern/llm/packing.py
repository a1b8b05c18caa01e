"""Best-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache, partial, reduce
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import textkit
from lectern.llm.staging import buckets_for, map_rows, prepare, running_total, staged, table

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
#: Beyond these code points, and for the end mark's own text, only ``tokenizers`` is asked.
_RARE = re.compile(r"[^\x00-ӿ -⁯₠-₿]|<\|endoftext\|>")


@cache
def _encoders(name: str):
    """The tokenizer of the file, and the same vocabulary as ranks in a faster library where the file has that twin."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = name if "/" in name else public_tokenizers.path(name)
    slow, twin = Tokenizer.from_file(path), Path(path).with_suffix(".tiktoken")
    if not twin.exists():
        return slow, None
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, twin.read_bytes().splitlines())}
    return slow, tiktoken.Encoding(twin.name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(texts: list[str], tokenizer: str = TOKENIZER) -> Iterator[np.ndarray]:
    """Ids of each text as ``tokenizers`` gives them without added special tokens."""
    slow, fast = _encoders(tokenizer)
    for t in texts:
        plain = fast is not None and not _RARE.search(t)
        yield np.array(fast.encode_ordinary(t) if plain else slow.encode(t, add_special_tokens=False).ids, dtype="<u4")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` tokens: full pieces but for the first, which has the rest."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _piecer(tokenizer: str, capacity: int, end_id: int, with_ids: bool):
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            docs = pdf["doc_id"].to_numpy()
            for at, run in textkit.chunks(pdf["text"]):
                rows = []
                for i, ids in enumerate(token_ids(run, tokenizer)):
                    ids = np.append(ids, np.array([end_id], "<u4"))
                    for k, (start, n) in enumerate(cut(len(ids), capacity)):
                        part = ids[start:start + n]
                        rows.append((docs[at + i], k, start, n, zlib.crc32(part.tobytes()), *([part.tolist()] if with_ids else [])))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])
    return pieces


#: What a superstep works on: documents of one length by their rank among those, and sequences with one gap, by their number.
STATE = "kind string, size long, start long, n long, to long, each long, base long"
#: Documents over the longest one's length divided by the first are matched together; those over that by the second open sequences together, if a sequence holds as many of each, or more than the third.
MATCHED, OPENED, FEW = 3, 1.5, 2
#: A superstep that places a smaller share of the documents that are matched together is the last before sequences are opened.
SETTLED = 0.1


Run = tuple[str, int, int, int, int | None, int | None, int | None]


def matched(runs: list[Run], low: int, capacity: int, bundled: bool) -> list[Run]:
    """Sorted documents and gaps, as runs, matched by one sweep for successors: placed documents, and the runs that are left.

    From the largest size down, gaps are laid on a pile and documents longer
    than ``low`` take from its top: the nearest gap above them that no longer
    document took, which is their successor, the smallest gap that takes them.
    Conflicts for a gap are so settled by rank, and each gap takes one document,
    or one bundle: where documents outnumber the gaps, several of a length go
    together, up to half a sequence. Documents that find no gap, shorter ones,
    and what is left of gaps are runs of the next superstep.
    """
    room = sum(r[3] for r in runs if r[0] == "gap")
    items = []
    out: list[Run] = []
    for kind, size, start, n, *_ in runs:
        if kind == "gap":
            items.append((size, 1, size, start, n, 1))
        elif kind == "doc" and size <= low:
            out.append(("doc", size, start, n, None, None, None))
        elif kind == "doc":
            each = max(1, min(-(-n // max(1, room)), capacity // (2 * size))) if bundled else 1
            items.append((size * each, 0, size, start, n, each))
    pile: list[list[int]] = []  # gap, first sequence, sequences
    for takes, is_gap, size, start, n, each in sorted(items, key=lambda x: (-x[0], -x[1], x[2], x[3])):
        if is_gap:
            pile.append([size, start, n])
            continue
        while n >= each and pile:
            gap, first, many = pile[-1]
            use = min(many, n // each)
            out.append(("plan", size, start, use * each, first, each, capacity - gap))
            if gap > takes:
                out.append(("gap", gap - takes, first, use, None, None, None))
            start, n = start + use * each, n - use * each
            if use == many:
                pile.pop()
            else:
                pile[-1][1:] = [first + use, many - use]
        if n:
            out.append(("doc", size, start, n, None, None, None))
    return out + [("gap", gap, first, n, None, None, None) for gap, first, n in pile]


def opened(runs: list[Run], longest: int, fresh: int, capacity: int) -> list[Run]:
    """The runs once the longest documents, which no gap takes, have opened sequences from number ``fresh`` on.

    Documents of one length fill sequences alone as far as their number goes.
    Of the others no more than the sequences that all of them need are opened,
    by the longest; the rest find their gaps in the next supersteps.
    """
    out: list[Run] = []
    single, each = [], capacity // longest
    for run in runs:
        kind, size, start, n, *_ = run
        if kind == "doc" and size * OPENED > longest and (capacity // size == each or each > FEW):
            whole, rest = divmod(n, each)
            if whole:
                out.append(("plan", size, start, whole * each, fresh, each, 0))
                if capacity > each * size:
                    out.append(("gap", capacity - each * size, fresh, whole, None, None, None))
                fresh += whole
            if rest:
                single.append((size, start + whole * each, rest))
        elif kind != "plan":
            out.append(run)
    need = -(-sum(n for _, _, n in single) // each)
    for size, start, n in sorted(single, reverse=True):
        use = min(n, need)
        if use:
            out.append(("plan", size, start, use, fresh, 1, 0))
            if capacity > size:
                out.append(("gap", capacity - size, fresh, use, None, None, None))
        if n > use:
            out.append(("doc", size, start + use, n - use, None, None, None))
        fresh, need = fresh + use, need - use
    return out


def superstep(state: DataFrame, step: Callable[[list[Run]], list[Run]]) -> DataFrame:
    """``step`` over the runs of a state, which is one for each length and for each match of equal gaps so far, however many documents there are."""
    names = [x.split()[0] for x in STATE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = [(k, int(size), int(start), int(n), None, None, None) for pdf in batches for k, size, start, n in zip(pdf["kind"], pdf["size"], pdf["start"], pdf["n"], strict=True) if k != "plan"]
        columns = list(zip(*step(sorted(runs)), strict=True)) or [()] * len(names)
        yield pd.DataFrame({c: pd.Series(v, dtype=object if c == "kind" else "Int64") for c, v in zip(names, columns, strict=True)})

    return staged(state.coalesce(1).mapInPandas(run, STATE))


def best_fit_plan(lengths: DataFrame, capacity: int) -> DataFrame:
    """Where documents go, by their rank among those of their length: rows ``plan`` of `STATE` for ``(length, n)``.

    The ``n`` documents of length ``size`` from rank ``start`` on go to sequences
    from ``to`` on, ``each`` to each, the first at ``base``. Long documents come
    first: those of like length are matched by supersteps (`matched`) until hardly
    any finds a gap, then the longest of those that are left open sequences, and
    so on until none is left. The driver sees totals only.
    """
    state = staged(lengths.selectExpr("'doc' as kind", "cast(length as long) as size", "0L as start", "cast(n as long) as n", "cast(null as long) as to", "cast(null as long) as each", "cast(null as long) as base").coalesce(1))
    plans, fresh, low, before, last = [], 0, -1, 0, ""
    while True:
        of = lambda kind, what: F.sum(F.when(F.col("kind") == kind, what))
        docs, active, room, placed, longest, end = state.agg(
            of("doc", F.col("n")), of("doc", F.when(F.col("size") > low, F.col("n"))), of("gap", F.col("n")), of("plan", F.col("n")),
            F.max(F.when(F.col("kind") == "doc", F.col("size"))), F.max(F.col("to") + F.ceil(F.col("n") / F.col("each")))).first()
        if placed:
            plans.append(state.where("kind = 'plan'"))
            fresh = max(fresh, end)
        if not docs:
            break
        if low < 0 or longest <= low:
            low, before, way = longest // MATCHED, 0, "bundles"
        elif last == "opened" or (placed or 0) > SETTLED * before:
            before, way = active, "bundles"
        else:
            way = "singles" if last == "bundles" and not placed and active > room else "opened"
        last = way if room else "opened"
        step = partial(opened, longest=longest, fresh=fresh, capacity=capacity) if last == "opened" else partial(matched, low=low, capacity=capacity, bundled=last == "bundles")
        state = superstep(state, step)
    return reduce(DataFrame.union, plans) if plans else state


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Packs the token ids of all documents, each followed by ``end_id``, into sequences of at most ``capacity``.

    Takes ``doc_id`` and ``text``; other columns are ignored. Returns one row per
    piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` and, ``with_ids``, ``ids``.

    Pieces are counted by length (at most ``capacity`` lengths), `best_fit_plan`
    matches them with gaps in supersteps, and each is placed by its rank among
    those of its length, which is found without a task that sees a whole
    length. The plan is joined by length; Spark broadcasts it by its own
    measure. A null or empty text has the end id alone. Repeated rows are packed
    once each. An empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    pieces = staged(map_rows(docs, _piecer(tokenizer, capacity, end_id, with_ids), schema))
    lengths = staged(pieces.groupBy("length").agg(F.count("*").alias("n")))
    n = lengths.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    plan = best_fit_plan(lengths, capacity).select(F.col("size").alias("of_length"), F.col("start").alias("from_rank"), F.col("n").alias("many"), "to", "each", "base")
    ranked = running_total(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank", buckets_for(n))
    fits = (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("from_rank") + F.col("many"))
    past = F.col("rank") - F.col("from_rank")
    placed = ranked.join(staged(plan.coalesce(1)), fits)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("to") + F.floor(past / F.col("each"))).cast("long").alias("sequence_id"), (F.col("base") + (past % F.col("each")) * F.col("length")).alias("offset"), *(["ids"] if with_ids else []))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
