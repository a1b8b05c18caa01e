"""Ordered rows: windows, sessions, numbering, spans and islands."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as K
from pyspark.sql.pandas.types import to_arrow_schema

from lectern.functions import fixed


def with_field(df: DataFrame, name: str, kind: K.DataType) -> K.StructType:
    """The schema of ``df`` and one more field."""
    return K.StructType([*df.schema.fields, K.StructField(name, kind)])


def overlapping_windows(sizes: DataFrame, keys: list[str], n: str, size: int, overlap: int) -> DataFrame:
    """Windows of ``size`` items from 1 that share ``overlap`` with the one before; the last stops at the end."""
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((F.col(n) - size) / step)).cast("int")
    return sizes.where(F.col(n) > 0).select(*keys, n, F.explode(F.sequence(F.lit(0), last)).alias("window")).select(*keys, "window", (F.col("window") * step + 1).alias("start"), F.least(F.col("window") * step + size, F.col(n)).alias("end"))


def stitched(messages: DataFrame, author: str, ts: str, gap: int = fixed.STITCH_SECONDS, channel: list[str] | None = None) -> DataFrame:
    """``unit`` of each message: it goes on while the message before, of whatever author, is of the same one and at most ``gap`` seconds older.

    The order is that of a channel. Without one it is global: messages are dealt
    by days, and a day begins with the last message, and the units, of those
    before it, so no task sorts more than a day. Messages of one time count by
    their authors, so one order holds for all steps and runs.
    """
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    rows = messages.withColumn("_s", seconds)
    by = list(channel or [])
    if not channel:
        rows, by = rows.withColumn("_day", F.floor(F.col("_s") / 86_400)), ["_day"]
    w = W.partitionBy(*by).orderBy(ts, author)
    before = {"_author": F.lag(author).over(w), "_before": F.lag("_s").over(w)}
    if not channel:
        lasts = rows.groupBy("_day").agg(F.max_by(F.struct(F.col(author).alias("a"), F.col("_s").alias("s")), F.struct(ts, author)).alias("_last"))
        days = lasts.select(F.col("_day").alias("_d"), F.lag("_last").over(W.orderBy("_day")).alias("_last"))  # a row a day
        rows = rows.join(days, rows["_day"].eqNullSafe(days["_d"])).drop("_d")
        before = {"_author": F.coalesce(before["_author"], F.when(F.row_number().over(w) == 1, F.col("_last.a"))), "_before": F.coalesce(before["_before"], F.col("_last.s"))}
    rows = rows.withColumns(before)
    joins = (F.col("_author") == F.col(author)) & (F.col("_s") - F.col("_before") <= gap)
    rows = rows.withColumn("_new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("unit", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    if not channel:
        sums = rows.groupBy("_day").agg(F.sum("_new").alias("_n"))
        starts = sums.select(F.col("_day").alias("_d"), F.coalesce(F.sum("_n").over(W.orderBy("_day").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
        rows = rows.join(starts, rows["_day"].eqNullSafe(starts["_d"])).withColumn("unit", F.col("unit") + F.col("_start")).drop("_d", "_start", "_day", "_last")
    return rows.drop("_new", "_s", "_author", "_before")


def units(messages: DataFrame, author: str, ts: str, channel: list[str] | None = None) -> DataFrame:
    by = channel or []
    return messages.groupBy(*by, "unit").agg(F.min(author).alias(author), F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("n"))


def heading_numbers(rows: DataFrame, keys: list[str], order: str, level: str) -> DataFrame:
    """Ids of headings and bodies: second-level headings count up, third-level ones within them, and bodies within the second-level section; a third-level heading doesn't restart the bodies.

    ``level`` is 0 for a body. Text before the first section is of section 0; a first-level heading is ``0``.
    """
    w = W.partitionBy(*keys).orderBy(order)
    rows = rows.withColumn("_h2", F.sum((F.col(level) == 2).cast("int")).over(w))
    inside = W.partitionBy(*keys, "_h2").orderBy(order)
    count = lambda k: F.sum((F.col(level) == k).cast("int")).over(inside).cast("string")
    rows = rows.withColumns({"_h3": count(3), "_n": count(0)})
    h2 = F.col("_h2").cast("string")
    out = F.when(F.col(level) == 1, F.lit("0")).when(F.col(level) == 2, F.concat_ws("-", h2, F.lit("0"))).when(F.col(level) == 3, F.concat_ws("-", h2, "_h3", F.lit("0"))).otherwise(F.concat_ws("-", h2, "_n"))
    return rows.withColumn("assigned_id", out).drop("_h2", "_h3", "_n")


def scanned(rows: DataFrame, keys: list[str], order: str, value: str, out: str, kind: K.DataType, step: Callable[[object, object, object], tuple]) -> DataFrame:
    """Adds ``out``: what ``step(state, place, value)`` gives, row after row of each key, with the next state; the first state is none.

    Rows come by in order, many keys to a batch, and a task holds one batch and
    one state, so neither many small keys nor one large one cost more than their rows.
    """
    first = F.row_number().over(W.partitionBy(*keys).orderBy(order)) == 1
    names = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for pdf in batches:
            found = []
            for new, place, v in zip(pdf["_first"], pdf[order], pdf[value], strict=True):
                state, x = step(None if new else state, place, v)
                found.append(x)
            yield pdf[names].assign(**{out: pd.Series(found, index=pdf.index, dtype=object)})

    return rows.withColumn("_first", first).sortWithinPartitions(*keys, order).mapInPandas(run, with_field(rows, out, kind))


def by_key(rows: DataFrame, keys: list[str], order: list[str], columns: list[str], make: Callable[[tuple, list[tuple]], list[tuple]], kind: K.StructType) -> DataFrame:
    """Rows that ``make(key, own)`` gives for each key, where ``own`` are its ``columns`` in order, as tuples of Python values.

    Keys come by one after the other in a sorted scan, many to a batch, so a key
    costs its rows and no call of its own; a task holds the rows of one key.
    """
    first = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) == 1
    names, n = [*keys, *columns], len(keys)
    made = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), made, strict=True)], schema=made)

        key, own = None, []
        for batch in batches:
            out: list[tuple] = []
            values = zip(*(batch.column(c).to_pylist() for c in names), strict=True)
            for new, row in zip(batch.column("_first").to_pylist(), values, strict=True):
                if new:
                    if own:
                        out += make(key, own)
                    key, own = row[:n], []
                own.append(row[n:])
            if out:
                yield told(out)
        if own and (out := make(key, own)):
            yield told(out)

    return rows.withColumn("_first", first).sortWithinPartitions(*keys, *order).select(*names, "_first").mapInArrow(run, kind)


def depth_ids(rows: DataFrame, keys: list[str], order: str, depth: str) -> DataFrame:
    """Decimal heading ids by depth: a counter for each depth, reset by any heading above it."""
    def number(at: list[int] | None, _, d: int) -> tuple:
        d = int(d)
        at = (at or [])[:d] + [0] * (d - len(at or []))
        at[-1] += 1
        return at, "-".join(map(str, at)) + "-0"
    return scanned(rows, keys, order, depth, "assigned_id", K.StringType(), number)


def body_ids(rows: DataFrame, keys: list[str], order: str, label: Column, consumes: Column) -> DataFrame:
    """Ids of bodies under the nearest label; rows that are transclusions, notes or tagged take no number and don't advance the count."""
    w = W.partitionBy(*keys).orderBy(order)
    rows = rows.withColumn("_label", F.last(label, ignorenulls=True).over(w)).withColumn("_c", consumes)
    n = F.sum(F.col("_c").cast("int")).over(W.partitionBy(*keys, "_label").orderBy(order))
    return rows.withColumn("assigned_id", F.when(F.col("_c") & F.col("_label").isNotNull(), F.concat_ws("-", "_label", n.cast("string")))).drop("_label", "_c")


def total_before(rows: DataFrame, order: str, value: str, out: str, width: int = 10_000) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over rows with a smaller whole-number ``order``, by ranges of it and then within each, so no task sees all rows."""
    rows = rows.withColumn("_range", F.floor(F.col(order) / width))
    totals = rows.groupBy("_range").agg(F.sum(value).alias("_t"))
    starts = totals.select("_range", F.coalesce(F.sum("_t").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))  # one row a range
    inside = W.partitionBy("_range").orderBy(order).rangeBetween(W.unboundedPreceding, -1)
    return rows.join(starts, "_range").withColumn(out, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_range", "_start")


def verse_buckets(verses: DataFrame, chapter: str, verse: str, k: int) -> DataFrame:
    """Days of up to ``k`` verses that never cross a chapter; chapters are whole numbers."""
    rows = verses.withColumn("_b", F.floor((F.row_number().over(W.partitionBy(chapter).orderBy(verse)) - 1) / k))
    days = rows.groupBy(chapter, "_b").agg(F.min(verse).alias("vstart"), F.max(verse).alias("vend"), F.count("*").alias("n"))
    per = days.groupBy(chapter).agg(F.count("*").alias("_d"))
    return days.join(total_before(per, chapter, "_d", "_before"), chapter).select((F.col("_before") + F.col("_b") + 1).cast("long").alias("day"), chapter, "vstart", "vend", "n")


def shifted(schedule: DataFrame, chapter: int, verse: int, to_day: int) -> DataFrame:
    """A schedule after an edge verse is moved to the neighbouring day; null ranges where that is refused: an inner verse, another chapter, or a day left empty."""
    here = (F.col("chapter") == chapter) & (F.lit(verse).between(F.col("vstart"), F.col("vend")))
    w = W.orderBy("day")  # one row a day
    rows = schedule.withColumn("_from", F.max(F.when(here, F.col("day"))).over(W.partitionBy()))
    forward = F.col("_from") == to_day - 1
    ok = F.max(here & (F.col("vend") > F.col("vstart")) & ((forward & (F.col("vend") == verse)) | ((F.col("_from") == to_day + 1) & (F.col("vstart") == verse)))).over(W.partitionBy()) & (F.max(F.when(F.col("day") == to_day, F.col("chapter"))).over(W.partitionBy()) == chapter)
    vend = F.when(F.col("day") == F.least("_from", F.lit(to_day)), F.when(forward, F.lit(verse - 1)).otherwise(F.lit(verse))).otherwise(F.col("vend"))
    vstart = F.when(F.col("day") == F.greatest("_from", F.lit(to_day)), F.when(forward, F.lit(verse)).otherwise(F.lit(verse + 1))).otherwise(F.col("vstart"))
    return rows.withColumns({"vstart": F.when(ok, vstart), "vend": F.when(ok, vend), "_w": F.row_number().over(w)}).drop("_from", "_w")


def nested_spans(headings: DataFrame, keys: list[str], total: str) -> DataFrame:
    """End of each heading's span: the next heading of its level or one above, else the content's end.

    There is a window for each level that occurs (as many as headings are deep),
    all over one sort of a content's headings.
    """
    depths = sorted(r[0] for r in headings.select("level").distinct().collect())
    ahead = W.partitionBy(*keys).orderBy("pos").rowsBetween(1, W.unboundedFollowing)
    end = F.lit(None).cast(dict(headings.dtypes)["offset"])
    for d in depths:
        end = F.when(F.col("level") == d, F.min(F.when(F.col("level") <= d, F.col("offset"))).over(ahead)).otherwise(end)
    return headings.withColumn("_n", end).select(*keys, "pos", "level", F.col("offset").alias("start"), F.coalesce("_n", total).alias("end"))


def content_offsets(lines: DataFrame, keys: list[str], order: str, text: str, joint: int = 1) -> DataFrame:
    """Span of each line in the joined content, ``joint`` code points between lines."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(text) + joint).over(w), F.lit(0))
    return lines.withColumn("start", start).withColumn("end", F.col("start") + F.length(text))


def join_votes(windows: DataFrame, joins: DataFrame, key: str) -> DataFrame:
    """Joins of block b and b + 1 that every window which sees both proposes: windows ``(key, window, start, end)``, joins ``(key, window, b)``."""
    asked = joins.select(key, "b").distinct()
    sees = asked.join(windows, key).where("start <= b and `end` >= b + 1").groupBy(key, "b").agg(F.count("*").alias("seen"))
    voted = joins.distinct().join(windows, [key, "window"]).where("start <= b and `end` >= b + 1").groupBy(key, "b").agg(F.count("*").alias("votes"))
    return voted.join(sees, [key, "b"]).withColumn("kept", F.col("votes") == F.col("seen"))


def islands(rows: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Runs of consecutive numbers."""
    w = W.partitionBy(*keys).orderBy(n)
    return rows.withColumn("_g", F.col(n) - F.row_number().over(w)).groupBy(*keys, "_g").agg(F.min(n).alias("first"), F.max(n).alias("last"), F.count("*").alias("n")).drop("_g")


def merged_intervals(spans: DataFrame, keys: list[str], touch: int = 0) -> DataFrame:
    """Overlapping spans as one, or such as are up to ``touch`` apart."""
    w = W.partitionBy(*keys).orderBy("start", "end")
    top = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    rows = spans.withColumn("_top", top)
    rows = rows.withColumn("_new", F.when(F.col("_top").isNotNull() & (F.col("start") <= F.col("_top") + touch), 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("_g")


def rolling_context(rows: DataFrame, keys: list[str], order: str, value: str, n: int) -> DataFrame:
    """The last ``n`` values before each row, in order."""
    return rows.withColumn("context", F.collect_list(value).over(W.partitionBy(*keys).orderBy(order).rowsBetween(-n, -1)))


def lanes(rows: DataFrame, keys: list[str], order: str, size: str, n: int) -> DataFrame:
    """``lane`` 0 to n - 1: contiguous parts of about equal size."""
    w = W.partitionBy(*keys)
    before = F.coalesce(F.sum(size).over(w.orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("lane", F.least(F.lit(n - 1), F.floor(before * n / F.greatest(F.lit(1), F.sum(size).over(w)))).cast("int"))


def capped_batches(rows: DataFrame, key: str, order: str, size: str, most: int, cap: int, breaks: str | None = None) -> DataFrame:
    """``batch`` of each row, closed by a count, a total size or a break: filled greedily in a note's order."""
    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, batch, n, total, out = pdf.sort_values(order), 0, 0, 0, []
        for i, x in enumerate(pdf[size]):
            if n and (n >= most or total + x > cap or (breaks and pdf[breaks].iloc[i])):
                batch, n, total = batch + 1, 0, 0
            out.append(batch)
            n, total = n + 1, total + x
        return pdf.assign(batch=out)
    return rows.groupBy(key).applyInPandas(fill, with_field(rows, "batch", K.IntegerType()))


def size_bounded_parts(lines: DataFrame, key: str, order: str, mark: str, most: int, slack: int = 150) -> DataFrame:
    """``part`` of each line: cut only at a mark, once a part has ``most - slack`` lines."""
    def cut(state: tuple[int, int] | None, _, m: bool) -> tuple:
        part, n = state or (0, 0)
        if m and n >= most - slack:
            part, n = part + 1, 0
        return (part, n + 1), part
    return scanned(lines, [key], order, mark, "part", K.IntegerType(), cut)


def same_target_islands(rows: DataFrame, keys: list[str], order: str, target: str) -> DataFrame:
    """Neighbours of one target as one row."""
    w = W.partitionBy(*keys).orderBy(order)
    new = F.when(F.lag(target).over(w).eqNullSafe(F.col(target)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    rows = rows.withColumn("_new", new).withColumn("_g", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "_g").agg(F.first(target).alias(target), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).drop("_g")


def gap_spans(spans: DataFrame, keys: list[str], total: str) -> DataFrame:
    """Spans with the gaps between them, before the first and after the last as spans of their own; overlaps are told by ``overlap``."""
    w = W.partitionBy(*keys).orderBy("start", "end")
    top = F.coalesce(F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = spans.withColumn("_top", top).withColumn("overlap", F.col("start") < F.col("_top"))
    before = rows.where(F.col("start") > F.col("_top")).select(*keys, F.col("_top").alias("start"), F.col("start").alias("end"), F.lit("gap").alias("kind"), F.lit(False).alias("overlap"))
    after = spans.groupBy(*keys).agg(F.max("end").alias("start"), F.max(total).alias("end")).where("start < `end`").select(*keys, "start", "end", F.lit("gap").alias("kind"), F.lit(False).alias("overlap"))
    return rows.select(*keys, "start", "end", F.lit("span").alias("kind"), "overlap").union(before).union(after)


def pinned_first(rows: DataFrame, key: str, pin: str, order: str) -> DataFrame:
    """A named row first, the rest as they were."""
    return rows.withColumn("pos", F.row_number().over(W.partitionBy().orderBy((F.col(key) != pin).cast("int"), order)))


def date_series(spark, start: str, n: int, skip_weekdays: tuple[int, ...] = (), skip_dates: tuple[str, ...] = ()) -> DataFrame:
    """``n`` dates from a start, without some weekdays (0 is Monday) and dates."""
    span = n * 7 + len(skip_dates) + 7
    days = spark.sql(f"select explode(sequence(date'{start}', date_add(date'{start}', {span}))) as day")
    days = days.where(~F.weekday("day").isin(*skip_weekdays or (-1,)) & ~F.col("day").cast("string").isin(*skip_dates or ("",)))
    return days.withColumn("n", F.row_number().over(W.orderBy("day"))).where(F.col("n") <= n)  # as many rows as asked for


def section_of(rows: DataFrame, keys: list[str], order: str, node: str) -> DataFrame:
    """Section of each row: its own where it has one, else that of the row before."""
    return rows.withColumn("section", F.last(node, ignorenulls=True).over(W.partitionBy(*keys).orderBy(order)))


def merged_chapters(notes: DataFrame, key: str, name: str, text: str) -> DataFrame:
    """Notes ``Chapter-NN`` of a key as one text, by the number."""
    n = F.regexp_extract(name, r"(\d+)", 1).try_cast("int")
    return notes.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(n.alias("n"), text))), lambda s: s[text]), "\n\n").alias("text"), F.count("*").alias("n_chapters"))
