"""Balanced shards by label propagation over links between documents, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.staging import buckets_for, running_total, staged, table

SHARDS, ROUNDS = 40, 6
OVERHEAD = 16


def _within(bounds: list[float], at: Column) -> Column:
    """The number of bounds that are at most ``at``: the range that it falls in."""
    return F.size(F.filter(F.array(*(F.lit(float(b)) for b in bounds)), lambda b: b <= at.cast("double"))).cast("int")


def _loads(df: DataFrame, weight: str, shards: int) -> list[int]:
    found = {r["shard"]: r["load"] for r in df.groupBy("shard").agg(F.sum(weight).alias("load")).collect()}
    return [int(found.get(s, 0) or 0) for s in range(shards)]


#: Classes of gain, each a half of a power of two, in which requests wait.
GAIN_CLASSES = 128


def propagate(items: DataFrame, links: DataFrame, shards: int, capacity: float, rounds: int = ROUNDS) -> DataFrame:
    """Moves linked items towards the shards of their neighbours: ``(id, weight)`` and ``(id, group)`` give ``(id, weight, shard)``.

    An item starts in a shard by the hash of its id. In each round every group
    sums its members' weight by shard (at most one row a group and shard), each
    member scores the shards of its groups, and asks for the best that has room,
    if that is better than its own. The members of a group that ask for a shard
    are one request, so no task sees a large group's rows; requests are met
    whole, in order of gain (by classes of half a power of two, then by a
    hash), as far as the shard's free quota goes. A group is joined to its
    members by an equi-join on its key, with one row a group on one side.
    """
    now = staged(items.select("id", "weight", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int").alias("shard")))
    for turn in range(rounds):
        load = _loads(now, "weight", shards)
        room = [max(0.0, capacity - x) for x in load]
        free = F.array(*(F.lit(float(x)) for x in room))
        member = links.join(now, "id")
        tally = member.groupBy("group", "shard").agg(F.sum("weight").alias("pull"))
        pulls = tally.groupBy("group").agg(F.collect_list(F.struct("shard", "pull")).alias("pulls"))  # at most one entry a shard
        scored = links.join(pulls, "group").select("id", "group", F.explode("pulls").alias("p")).select("id", F.col("p.shard").alias("to"), F.col("p.pull").alias("pull"), "group")
        score = scored.groupBy("id", "to").agg(F.sum("pull").alias("score"), F.min("group").alias("group"))
        rated = score.join(now, "id").withColumn("own", F.col("to") == F.col("shard"))
        rated = rated.where(F.col("own") | (F.element_at(free, F.col("to") + 1) >= F.col("weight")))
        # the heaviest shard of the group; the hash settles ties alike for all its members
        order = F.struct("score", F.xxhash64("group", "to"), F.col("to"))
        best = rated.groupBy("id").agg(F.max_by(F.struct("to", "score", "group"), order).alias("b"), F.first("weight").alias("weight"), F.first("shard").alias("from"), F.max(F.when(F.col("own"), F.col("score"))).alias("here"))
        asks = staged(best.where("b.to <> `from` and b.score >= coalesce(here, 0)").select("id", "weight", F.col("b.to").alias("to"), F.col("b.group").alias("group"), (F.col("b.score") - F.coalesce("here", F.lit(0))).alias("gain")))
        requests = staged(asks.groupBy("to", "group").agg(F.sum("weight").alias("weight"), F.max("gain").alias("gain")))
        n = requests.count()
        if not n:
            break
        many = buckets_for(n, per_bucket=20_000, least=8)
        rank = F.lit(GAIN_CLASSES) - F.least(F.lit(GAIN_CLASSES), F.floor(2 * F.log2(F.greatest(F.col("gain"), F.lit(1)).cast("double")))).cast("int")
        place = rank * many + F.pmod(F.xxhash64("group", F.lit(turn)), F.lit(many)).cast("int")
        queued = running_total(requests, ["to"], ["gain", "group"], "before", many, F.col("weight"), place)
        met = queued.where(F.col("before") + F.col("weight") <= F.element_at(free, F.col("to") + 1)).select("to", "group")
        moves = asks.join(met, ["to", "group"]).select("id", "to")
        now = staged(now.join(moves, "id", "left").select("id", "weight", F.coalesce("to", "shard").alias("shard")))
    return now


def balanced_shards(docs: DataFrame, shards: int = SHARDS, links: DataFrame | None = None) -> DataFrame:
    """Deals documents into ``shards`` of nearly equal bytes that part few links.

    Takes ``doc_id`` and ``text``; other columns are ignored. ``links`` is
    ``(doc_id, group)``: documents with a group in common are linked; without
    it those with equal texts are. Returns ``doc_id``, ``size`` (UTF-8 bytes of
    the text and 16), ``text_crc32``, ``shard`` and ``slot`` (from 0 in its shard,
    without gaps).

    Groups over three quarters of a shard are first split into as few equal parts
    of that size as will do, as no shard can hold them. Linked documents are
    placed by `propagate`. Where a shard is over its quota then, whole groups
    leave it, and go as such to shards with room before the unlinked documents
    fill what is left, larger ones first, so that what remains uneven is of the
    size of the smallest documents. A null text has 16 bytes, crc32 of nothing, and no
    link; empty texts are equal texts. Repeated rows are dealt once each. An
    empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("same"))
    base = staged(rows)
    n, total = base.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    base = base.withColumn("id", F.xxhash64("doc_id", "text_crc32", "size"))
    if links is None:
        groups = staged(base.groupBy("same").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).where("n > 1 and same is not null"))
        linked = base.join(groups, "same").select("doc_id", "id", "size", F.col("same").alias("group"), "bytes")
    else:
        given = links.select("doc_id", F.col("group").cast("string").cast("binary").alias("group")).where("group is not null").distinct()
        joined = base.join(given, "doc_id")
        groups = staged(joined.groupBy("group").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).where("n > 1"))
        linked = joined.join(groups, "group").select("doc_id", "id", "size", "group", "bytes")
    capacity = total / shards
    whole = max(1.0, 0.75 * capacity)
    part = F.col("bytes") / F.ceil(F.col("bytes") / whole)
    large = linked.where(F.col("bytes") > whole)
    split = running_total(large, ["group"], ["doc_id", "id"], "before", buckets_for(n), F.col("size")).select("id", "size", F.concat("group", F.least(F.floor(F.col("before") / part), F.ceil(F.col("bytes") / whole) - 1).cast("string").cast("binary")).alias("group"))
    linked = staged(linked.where(F.col("bytes") <= whole).select("id", "size", "group").union(split))
    items = linked.groupBy("id").agg(F.min("size").alias("weight"))
    placed = propagate(items, linked.select("id", "group").distinct(), shards, capacity)
    first_group = linked.groupBy("id").agg(F.min("group").alias("group"))
    base = staged(base.join(placed.drop("weight"), "id", "left").join(first_group, "id", "left"))
    return _dealt(_filled(base, shards, n, total), n)


def _filled(base: DataFrame, shards: int, n: int, total: int) -> DataFrame:
    """Gives the rows without a shard, and the groups over a shard's quota, to the shards with room.

    What is dealt is a unit: all rows of a group, added up first, or a row
    without a group. A group that propagation left in several shards goes to
    that with most of it, so units stay whole.
    """
    many = buckets_for(n)
    goal = [total * (s + 1) // shards - total * s // shards for s in range(shards)]
    base = staged(base.withColumn("unit", F.when(F.col("shard").isNotNull(), F.xxhash64("group")).otherwise(F.xxhash64("doc_id", "id"))))
    parts = base.where("shard is not null").groupBy("unit", "shard").agg(F.sum("size").alias("size"))
    homes = parts.groupBy("unit").agg(F.max_by("shard", F.struct("size", "shard")).alias("shard"), F.sum("size").alias("size"))
    kept = running_total(homes, ["shard"], ["unit"], "before", buckets_for(n, least=8), F.col("size"))
    limit = F.element_at(F.array(*(F.lit(g) for g in goal)), F.col("shard") + 1)
    kept = staged(kept.select("unit", "size", F.when(F.col("before") + F.col("size") <= limit, F.col("shard")).alias("shard")))
    load = _loads(kept.where("shard is not null"), "size", shards)
    out = kept.where("shard is not null").select("unit", "shard")
    homeless = kept.where("shard is null").select("unit", "size")
    single = base.where("shard is null").select("doc_id", "id", "unit", "size", "text_crc32")
    mean = total / max(1, n)
    edges = [16 * mean, 4 * mean, mean, mean / 4, 0.0]  # size classes, larger first
    power = F.floor(F.log2("size")).cast("int")
    classes = {r["power"]: r["most"] for r in homeless.groupBy(power.alias("power")).agg(F.max("size").alias("most")).collect()}
    for k, most in sorted(classes.items(), reverse=True):
        # a shard takes as many of the class as it has room for at the class's largest; what finds none goes by room alone
        slots = [max(0, g - x) // most for g, x in zip(goal, load, strict=True)]
        bounds = [sum(slots[:s + 1]) for s in range(shards)]
        ranked = running_total(homeless.where(power == k), [], ["unit"], "before", many)
        fit = staged(ranked.withColumn("shard", _within(bounds, F.col("before"))))
        got = fit.where(F.col("shard") < shards)
        load[:] = [a + b for a, b in zip(load, _loads(got, "size", shards), strict=True)]
        out = out.union(got.select("unit", "shard"))
        rest = _into_room(fit.where(F.col("shard") >= shards).drop("before", "shard"), ["unit"], shards, goal, load, many, ["unit"])
        out = out.union(rest) if rest is not None else out
    moved = staged(out)
    rows = base.where("shard is not null").drop("shard").join(moved, "unit").select("doc_id", "size", "text_crc32", "shard", "id")
    above = float("inf")
    for edge in edges:
        rank = single.where((F.col("size") > edge) & (F.col("size") <= above))
        got = _into_room(rank, ["doc_id", "id"], shards, goal, load, many, ["doc_id", "size", "text_crc32"], ["id"])
        rows = rows.union(got) if got is not None else rows
        above = edge
    return rows


def _into_room(rank: DataFrame, order: list[str], shards: int, goal: list[int], load: list[int], many: int, columns: list[str], last: list[str] = ()) -> DataFrame | None:
    """Deals units to shards in proportion to the room of each, and adds their sizes to ``load``."""
    left = rank.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if not left:
        return None
    gap = [max(0, g - x) for g, x in zip(goal, load, strict=True)]
    room = sum(gap)
    share = [left * g / room if room else left / shards for g in gap]
    bounds = [sum(share[:s + 1]) for s in range(shards - 1)]
    queued = running_total(rank, [], order, "before", many, F.col("size"))
    got = staged(queued.withColumn("shard", _within(bounds, F.col("before") + F.col("size") / 2)))
    load[:] = [a + b for a, b in zip(load, _loads(got, "size", shards), strict=True)]
    return got.select(*columns, "shard", *last)


def _dealt(placed: DataFrame, n: int) -> DataFrame:
    # a shard of small documents has far more rows than others
    return running_total(placed, ["shard"], ["doc_id", "id"], "slot", max(16, min(n // 500, int(n ** 0.5)))).select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))


def parted_links(dealt: DataFrame, links: DataFrame) -> tuple[int, int]:
    """Links ``(doc_id, group)`` between documents of a group, as pairs: those whose ends are in two shards, and all."""
    by_shard = links.join(dealt.select("doc_id", "shard"), "doc_id").groupBy("group", "shard").agg(F.count("*").cast("double").alias("n"))
    of = by_shard.groupBy("group").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    cut, whole = of.agg(F.coalesce(F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2), F.lit(0.0)), F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0))).first()
    return int(cut), int(whole)


def op2_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = balanced_shards(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
