"""Secrets: three fixed patterns and a battery of randomness tests, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.staging import staged, table

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: What is tested for randomness: runs of 20 or more characters of any of the encodings.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
#: Letters by how common they are in text, so that words stand in one half of the alphabet.
_COMMON = "etaoinsrhldcumfpgwybvkxjqz"
#: Encodings, the narrowest first; a token is taken to be in the first that has all its characters, a word with a capital as one of small letters.
ENCODINGS = (
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("lower26", _COMMON),
    ("upper26", _COMMON.upper()),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("upper36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64url", "-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"),
    ("mixed66", "+-/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"),
)
BINS, RATE, LARGEST_BAND = 50, 0.05, 12


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def before(values: Column) -> Column:
    """The sum of the values before each, of an array of whole numbers.

    The array is taken in runs of about the root of its length: a running sum in each, and one of the runs' sums.
    """
    def sums(v: Column) -> Column:
        walk = F.aggregate(v, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))
        return walk

    def blocks(v: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(v))).cast("int")
        inner = F.transform(F.sequence(F.lit(0), F.ceil((F.size(v) - 1) / size).cast("int")), lambda i: sums(F.slice(v, i * size + 1, size)))
        return let(inner, lambda runs: let(sums(F.transform(runs, lambda r: r["at"]))["out"], lambda starts: F.flatten(F.transform(runs, lambda r, i: F.transform(r["out"], lambda x: x + starts[i])))))

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(blocks(values))


def _located(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, text>>`` of the matches of a pattern that never matches nothing; code points."""
    gaps, found = F.transform(F.split(text, pattern, -1), lambda g: F.length(g)), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")
    both = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    place = lambda x, at: F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + F.length(x["hit"])).alias("end"), x["hit"].alias("text"))
    located = let(both, lambda m: F.zip_with(m, before(F.transform(m, lambda x: x["gap"] + F.length(x["hit"]))), place))
    return F.when(F.rlike(text, F.lit(pattern)), located).otherwise(none)


def _count_before(points: Column, queries: Column, or_at: bool) -> Column:
    """For each of some rising places the number of points before it (or at it): both sides sorted as one array, and a running sum."""
    mine = F.transform(points, lambda p: F.struct(p.alias("at"), F.lit(0 if or_at else 1).alias("turn"), F.lit(1).alias("n")))
    asked = F.transform(queries, lambda q: F.struct(q.alias("at"), F.lit(1 if or_at else 0).alias("turn"), F.lit(0).alias("n")))

    def answers(s: Column) -> Column:
        told = F.zip_with(s, before(F.transform(s, lambda x: x["n"])), lambda x, n: F.struct(x["n"].alias("n"), n.alias("sum")))
        return F.transform(F.filter(told, lambda x: x["n"] == 0), lambda x: x["sum"])

    return let(F.array_sort(F.concat(mine, asked)), answers)


def apart(tokens: Column, spans: Column) -> Column:
    """The tokens (rising, none over another) that overlap no span: as many spans end at or before their start as begin before their end."""
    of = lambda a, f: F.transform(a, lambda x: x[f])
    begun, over = _count_before(of(spans, "start"), of(tokens, "end"), False), _count_before(of(spans, "end"), of(tokens, "start"), True)
    kept = let(F.zip_with(begun, over, lambda x, y: x == y), lambda free: F.filter(tokens, lambda t, i: free[i]))
    return F.when((F.size(tokens) == 0) | (F.size(spans) == 0), tokens).otherwise(kept)


def base_spans(text: Column) -> Column:
    """``array<struct<start, kind, end>>`` of the three patterns, sorted by start, then kind as listed (as its number)."""
    of = lambda hits, kind: F.transform(hits, lambda h: F.struct(h["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), h["end"].alias("end")))
    assign = F.filter(_located(text, ASSIGN), lambda h: F.length(F.regexp_extract(h["text"], "^" + ASSIGN, 2)) >= 6)
    return F.array_sort(F.concat(of(assign, "assign"), of(_located(text, ACCESS), "access"), of(_located(text, HEX), "hex")))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by the error function's approximation 7.1.26 of Abramowitz and Stegun."""
    x = F.abs(z) / 2 ** 0.5
    t = 1 / (1 + 0.3275911 * x)
    tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x) / 2
    return F.greatest(F.lit(1e-300), F.when(z >= 0, tail).otherwise(1 - tail))


def encoding_of(token: Column) -> Column:
    """Number of the token's encoding."""
    choice = F.when(F.rlike(token, F.lit(r"^[A-Z][a-z]+$")), F.lit([n for n, _ in ENCODINGS].index("lower26")))
    for i, (_, letters) in enumerate(ENCODINGS):
        choice = choice.when(F.translate(token, letters, "") == "", F.lit(i))
    return choice


def randomness(tokens: DataFrame) -> DataFrame:
    """Adds ``p`` to rows with ``token`` and ``encoding``: how likely a random token of its encoding looks less random.

    Three tests, each against a uniform choice of symbols: chi-squared over the
    counts of the alphabet's symbols (as a normal deviate, by the cube root),
    runs in the lower and upper half of the alphabet (too few or too many; a
    symbol changes halves half of the time), and correlation of each symbol's
    place in the alphabet with the next one's. Their values are combined by
    Fisher's method.
    """
    alphabet = F.element_at(F.array(*(F.lit(a) for _, a in ENCODINGS)), F.col("encoding") + 1)
    k, n = F.length(alphabet).cast("double"), F.length("token").cast("double")
    tokens = tokens.withColumn("codes", F.transform(F.split(F.when(F.rlike("token", F.lit(r"^[A-Z][a-z]+$")), F.lower("token")).otherwise(F.col("token")), ""), lambda c: F.instr(alphabet, c).cast("double")))
    codes = F.filter("codes", lambda x: x > 0)
    squares = F.aggregate(F.array_distinct("codes"), F.lit(0.0), lambda acc, c: acc + F.pow(F.size(F.filter("codes", lambda x: x == c)).cast("double"), F.lit(2)))
    chi = squares * k / n - n
    deviate = (F.pow(F.greatest(chi, F.lit(1e-9)) / (k - 1), F.lit(1 / 3)) - (1 - 2 / (9 * (k - 1)))) / F.sqrt(2 / (9 * (k - 1)))
    start = F.struct(*(F.lit(x).alias(a) for a, x in (("prev", -1.0), ("side", -1.0), ("runs", 0.0), ("s", 0.0), ("ss", 0.0), ("sp", 0.0))))
    side = lambda x: F.when(x > k / 2, 1.0).otherwise(0.0)
    walk = F.aggregate(codes, start, lambda a, x: F.struct(x.alias("prev"), side(x).alias("side"), (a["runs"] + F.when(side(x) != a["side"], 1.0).otherwise(0.0)).alias("runs"), (a["s"] + x).alias("s"), (a["ss"] + x * x).alias("ss"), (a["sp"] + F.when(a["prev"] > 0, a["prev"] * x).otherwise(0.0)).alias("sp")))
    tokens = tokens.withColumns({"deviate": deviate, "walk": walk})
    w = F.col("walk")
    runs_z = F.abs(w["runs"] - 1 - (n - 1) / 2) / (F.sqrt(n - 1) / 2)
    mean = w["s"] / n
    variance = w["ss"] / n - mean * mean
    serial = (w["sp"] / (n - 1) - mean * mean) / F.greatest(variance, F.lit(1e-9))
    serial_z = F.abs(serial + 1 / (n - 1)) * F.sqrt(n)
    logs = F.log(_upper_tail(F.col("deviate"))) + F.log(F.least(F.lit(1.0), 2 * _upper_tail(runs_z))) + F.log(F.least(F.lit(1.0), 2 * _upper_tail(serial_z)))
    half = -logs
    return tokens.withColumn("p", F.least(F.lit(1.0), F.exp(-half) * (1 + half + half * half / 2))).drop("codes", "deviate", "walk")


def thresholds(scored: DataFrame) -> dict[tuple[int, int], float]:
    """Least ``p`` of a discovery by encoding and length band, so that at most ``RATE`` of a band's discoveries are expected to be no random tokens.

    Random tokens have ``p`` spread evenly over 0 to 1, others have it near 0,
    so twice the tokens over one half estimate the random ones, of any length
    that the tests tell apart. From the top down the bins of a band are taken
    in as long as those over the estimate stay within the rate. At most
    encodings x bands x bins counts go to the driver.
    """
    counts = scored.groupBy("encoding", "band", F.least(F.lit(BINS - 1), F.floor(F.col("p") * BINS)).cast("int").alias("bin")).agg(F.count("*").alias("n")).collect()
    bands: dict[tuple[int, int], list[int]] = {}
    for r in counts:
        bands.setdefault((r["encoding"], r["band"]), [0] * BINS)[r["bin"]] = r["n"]
    out = {}
    for key, row in bands.items():
        random = 2 * sum(row[BINS // 2:])
        taken, least = 0, None
        for b in range(BINS - 1, -1, -1):
            taken += row[b]
            excess = taken - random * (BINS - b) / BINS
            slack = RATE * taken + 2 * max(1.0, random * (BINS - b) / BINS) ** 0.5  # the estimate's own error
            if taken and excess <= slack and random:
                least = b / BINS
        if least is not None:
            out[key] = max(least, 1 / BINS)
    return out


def secrets(docs: DataFrame) -> DataFrame:
    """Finds secrets in every text: ``doc_id``, ``base`` and ``spans``, each ``array<struct<start, kind, end>>``.

    Takes ``doc_id`` and ``text``; other columns are ignored. Offsets count code
    points, ends are exclusive, ``kind`` is a place in ``KINDS``. ``base`` has the
    matches of the three patterns, ``spans`` also the tokens that the battery
    takes for random, where they overlap none of these. How random a token must
    look is settled by encoding and length over all documents, so whether a
    token is taken depends on the corpus that it stands in. A null or empty
    text has none; repeated rows are each searched; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), base_spans(text).alias("base"), _located(text, TOKEN).alias("tokens"))
    found = staged(found.withColumn("tokens", apart(F.col("tokens"), F.col("base"))).withColumn("row", F.monotonically_increasing_id()))
    exploded = found.where(F.size("tokens") > 0).select("row", F.explode("tokens").alias("t")).select("row", F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.col("t.text").alias("token"))
    rows = exploded.withColumn("encoding", encoding_of(F.col("token"))).withColumn("band", F.least(F.lit(LARGEST_BAND), F.floor(F.log2(F.length("token").cast("double")) * 2)).cast("int"))
    scored = staged(randomness(rows).drop("token"))
    least = thresholds(scored)
    passed = F.lit(False)
    for (encoding, band), p in sorted(least.items()):
        passed = passed | ((F.col("encoding") == encoding) & (F.col("band") == band) & (F.col("p") >= p))
    hits = scored.where(passed).groupBy("row").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("random")).alias("kind"), "end")).alias("more"))
    joined = found.join(hits, "row", "left")
    return joined.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>")))).alias("spans"))


def joined(spans: str) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *map(count, range(3)), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
