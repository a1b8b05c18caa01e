"""How queries are listed: a name, the operators of the survey that it runs, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import fixed
from lectern.sources.stage import ship, small

Query = Callable[[SparkSession, str], DataFrame]


class Listing:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}
        self.covers: dict[str, tuple[str, ...]] = {}

    def add(self, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
        def put(f: Query) -> Query:
            self.queries[f.__name__] = f
            self.covers[f.__name__] = tuple(covers.split())
            if sql:
                self.oracles[f.__name__] = sql
            return f
        return put


#: Rows of `part` of one task, each of which may become some dozen lines.
PART_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Texts, parts and events in fewer files than there are cores are dealt out first, as a file of one row group is one task.

    Parts are dealt by their key to tasks of a bounded number of rows: what the
    queries make of a part goes by that key, and so stays in its task.
    """
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name == "part":
        return df.repartition(max(cores, -(-df.count() // PART_ROWS)), "p_partkey")
    if name in ("documents", "pages", "events") and small(df, cores):
        return df.repartition(cores)
    return df


def longs(df: DataFrame, *columns: str) -> DataFrame:
    """Places and counts as the whole numbers that SQL gives."""
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


_WORD = f"[a-zA-Z{fixed.TRANSLITERATION}À-ÖØ-öø-ÿß]+"
STOP = "[" + ", ".join(f"'{w}'" for w in fixed.STOPWORDS) + "]"


def sql_clean(text: str) -> str:
    out = f"regexp_replace({text}, '(?s)\\A---.*?\\n---', '')"
    for pattern in (r"(?m)^!\[\[.*$", r"\^[\w\-]+", r"[#\[\]`*_>|§]", r"\d+"):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return out


def sql_words(text: str) -> str:
    return f"list_transform(regexp_extract_all({sql_clean(text)}, '{_WORD}(?:-{_WORD})*'), lambda x: lower(x))"


def sql_terms(text: str) -> str:
    return f"list_filter({sql_words(text)}, lambda x: length(x) > 2 and not list_contains({STOP}, x))"


def sql_formula(text: str) -> str:
    t = f"regexp_replace(regexp_replace({text}, '\\[[^\\]]*\\]', '', 'g'), '(?m)^#+.*$', '', 'g')"
    return f"list_filter(regexp_split_to_array(lower(regexp_replace({t}, '[!-/:-@\\[-`{{-~“”‘’—–…]', ' ', 'g')), '\\s+'), lambda x: length(x) >= 3 and not regexp_full_match(x, '\\d+') and not list_contains({STOP}, x))"


def sql_variants(w: str) -> str:
    n = f"length({w})"
    cut = lambda k: f"left({w}, {n} - {k})"
    parts = [w, f"{w} || 's'", f"{w} || 'es'", f"case when {w} like '%es' and {n} > 4 then {cut(2)} end", f"case when {w} like '%s' and {n} > 3 then {cut(1)} end", f"case when {w} like '%ing' and {n} > 5 then {cut(3)} end", f"case when {w} like '%ing' and {n} > 5 then {cut(3)} || 'e' end", f"case when {w} like '%ed' and {n} > 4 then {cut(2)} end", f"case when {w} like '%ed' and {n} > 4 then {cut(1)} end"]
    return f"list_filter(list_distinct([{', '.join(parts)}]), lambda x: x is not null)"


TOKENS_SQL = f"tok as (select doc_id, lang, unnest({sql_terms('text')}) as word from documents)"
TF_SQL = f"{TOKENS_SQL}, cnt as (select lang, word, count(*) as \"count\" from tok group by all), tf as (select *, sum(\"count\") over (partition by lang)::bigint as total from cnt)"
IDF_SQL = "nd as (select count(distinct doc_id) as n from tok), idf as (select word, count(distinct doc_id) as df, round(ln((1 + any_value(n)) / (1 + count(distinct doc_id))) + 1, 6) as idf from tok, nd group by word)"
SCORED_SQL = f"{TF_SQL}, {IDF_SQL}, scored as (select lang, word, \"count\", total, idf, round(\"count\" / total * idf * {fixed.TFIDF_SCALE}, 4) as score from tf join idf using (word))"
RANKED_SQL = f"{SCORED_SQL}, ranked as (select *, row_number() over (partition by lang order by score desc, word) as rank from scored)"
LINES_SQL = "ln as (select doc_id, lang, source, i as line_no, string_split(text, chr(10))[i] as line from (select *, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents))"
