"""Model calls as injected functions, and the checks of what they answer."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as K

Transform = Callable[..., DataFrame]
_ADAPTERS: dict[str, Transform] = {}


def register_adapter(name: str, f: Transform) -> None:
    _ADAPTERS[name] = f


def adapt(name: str, *frames: DataFrame, **options) -> DataFrame:
    """Runs a named transform of DataFrames."""
    if name not in _ADAPTERS:
        raise KeyError(f"no adapter {name!r}; there are {sorted(_ADAPTERS)}")
    return _ADAPTERS[name](*frames, **options)


def call_model(rows: DataFrame, prompt: str, call: Callable[[list[str]], list[str]], out: str = "reply", batch: int = 20, fallback: Callable[[list[str]], list[str]] | None = None) -> DataFrame:
    """Replies to a column of prompts in batches; a batch that fails goes to the fallback, one by one."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies: list[str | None] = []
            prompts = pdf[prompt].tolist()
            for at in range(0, len(prompts), batch):
                part = prompts[at:at + batch]
                try:
                    got = call(part)
                    if len(got) != len(part):
                        raise ValueError("replies and prompts differ in number")
                except Exception:
                    if fallback is None:
                        raise
                    got = [fallback([p])[0] for p in part]
                replies += got
            yield pdf.assign(**{out: replies})
    return rows.mapInPandas(run, K.StructType([*rows.schema.fields, K.StructField(out, K.StringType())]))


def marked_reply(reply: Column | str, n: Column | int) -> Column:
    """Parts of a reply after marks ``[[1]]`` to ``[[n]]``; null unless the marks are just these, in order."""
    marks = F.transform(F.regexp_extract_all(reply, F.lit(r"\[\[(\d+)\]\]"), F.lit(1)), lambda x: x.cast("int"))
    parts = F.transform(F.slice(F.split(reply, r"\[\[\d+\]\]"), 2, 1_000_000), lambda x: F.trim(x))
    return F.when((F.size(marks) > 0) & (marks == F.sequence(F.lit(1), F.greatest(F.lit(1), F.lit(n) if isinstance(n, int) else n))), parts)


def json_reply(reply: Column | str, ids: Column) -> Column:
    """Map of ids to texts of a JSON array of objects; null unless the ids are those asked for, in order."""
    items = F.from_json(reply, "array<struct<id:string,text:string>>")
    return F.when(F.transform(items, lambda x: x["id"]) == ids, F.map_from_entries(F.transform(items, lambda x: F.struct(x["id"], x["text"]))))


def numbered_reply(reply: Column | str, n: Column | int) -> Column:
    """Lines ``1| …`` to ``n| …`` of a reply without their numbers; null unless they are just these."""
    lines = F.filter(F.split(reply, "\n"), lambda x: F.trim(x) != "")
    numbers = F.transform(lines, lambda x: F.regexp_extract(x, r"^\s*(\d+)\|", 1).try_cast("int"))
    want = F.sequence(F.lit(1), F.greatest(F.lit(1), F.lit(n) if isinstance(n, int) else n))
    return F.when(numbers == want, F.transform(lines, lambda x: F.regexp_replace(x, r"^\s*\d+\|\s?", "")))


def reply_gates(original: Column | str, reply: Column | str, low: float = 0.5, high: float = 2.0) -> Column:
    """Whether a reply is of about the original's length, keeps its reference marks and isn't wrapped in a fence."""
    refs = lambda c: F.array_sort(F.regexp_extract_all(c, F.lit(r"⟦\d+⟧"), F.lit(0)))
    share = F.length(reply) / F.greatest(F.length(original), F.lit(1))
    return share.between(low, high) & (refs(original) == refs(reply)) & ~F.rlike(reply, F.lit(r"\A\s*```"))


def as_events(replies: DataFrame, key: str, order: str, size: int) -> DataFrame:
    """Replies of a key as events of ``size`` each, as they would be streamed: ``(key, event, text)``, the last one saying that it is the last."""
    w = W.partitionBy(key).orderBy(order)
    rows = replies.withColumn("event", F.floor((F.row_number().over(w) - 1) / size).cast("int"))
    items = F.transform(F.array_sort(F.collect_list(F.struct(order, "reply"))), lambda s: s["reply"])
    events = rows.groupBy(key, "event").agg(items.alias("replies"))
    last = F.max("event").over(W.partitionBy(key)) == F.col("event")
    return events.select(key, "event", F.concat(F.lit("event: "), F.when(last, "done").otherwise("batch"), F.lit("\ndata: "), F.to_json("replies"), F.lit("\n\n")).alias("text"))


def isolate(units: list, probe: Callable[[list], bool]) -> list:
    """The units that a probe refuses, found by halving."""
    if not units or probe(units):
        return []
    if len(units) == 1:
        return units
    half = len(units) // 2
    return isolate(units[:half], probe) + isolate(units[half:], probe)


class QuotaSpent(Exception):
    """A service says that no more calls are allowed; it is not tried again."""


def retrying(call: Callable[[list[str]], list[str]], tries: int = 4, wait: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[list[str]], list[str]]:
    """A call that is made again after a failure, each time after twice the wait; a spent quota, and the last failure, are raised."""
    def run(prompts: list[str]) -> list[str]:
        for n in range(tries):
            try:
                return call(prompts)
            except QuotaSpent:
                raise
            except Exception:
                if n == tries - 1:
                    raise
                sleep(wait * 2 ** n)
        raise AssertionError
    return run


def repaired(rows: DataFrame, prompt: str, call: Callable[[list[str]], list[str]], good: Callable[[str, str], bool], passes: int = 3, out: str = "reply") -> DataFrame:
    """Replies asked for again, one by one, until they are well formed or the passes are used up; ``passes`` tells how many it took, 0 if none was good."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for p in pdf[prompt]:
                reply, took = None, 0
                for n in range(1, passes + 1):
                    reply = call([p])[0]
                    if good(p, reply):
                        took = n
                        break
                found.append((reply, took))
            yield pdf.assign(**{out: [r for r, _ in found], "passes": [n for _, n in found]})
    return rows.mapInPandas(run, K.StructType([*rows.schema.fields, K.StructField(out, K.StringType()), K.StructField("passes", K.IntegerType())]))


def delivered(payloads: DataFrame, key: str, post: Callable[[str], str], ledger: DataFrame | None = None, dry_run: bool = True) -> DataFrame:
    """Payloads that a ledger doesn't have, posted, with the answer as a ledger row; a dry run posts nothing."""
    rows = payloads if ledger is None else payloads.join(ledger.where("status = 'sent'").select(key).distinct(), key, "left_anti")
    if dry_run:
        return rows.select(key, F.lit("dry-run").alias("status"), F.lit(None).cast("string").alias("answer"))
    return call_model(rows, "payload", lambda batch: [post(p) for p in batch], "answer").select(key, F.lit("sent").alias("status"), "answer")
