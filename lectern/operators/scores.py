"""Scorecards over issues, commits and days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import text as T


def tally(rows: DataFrame, scope: DataFrame, group: str, verse: str, result: str) -> DataFrame:
    """Verses clean, in error, or only mismatched, by chapter and in all (a null chapter); an error outweighs mismatches, whose rows are counted too."""
    per = rows.groupBy(group, verse).agg(F.max((F.col(result) == "ERROR").cast("long")).alias("_e"), F.sum((F.col(result) == "MISMATCH").cast("long")).alias("_m"))
    all_ = scope.select(group, verse).distinct().join(per, [group, verse], "left").fillna(0, ["_e", "_m"])
    return all_.rollup(group).agg(F.count("*").alias("verses"), F.sum(((F.col("_e") == 0) & (F.col("_m") == 0)).cast("long")).alias("clean"), F.sum("_e").alias("error"), F.sum(((F.col("_e") == 0) & (F.col("_m") > 0)).cast("long")).alias("mismatch_only"), F.sum("_m").alias("mismatch_rows"))


def coverage(rows: DataFrame, group: str, n: str) -> DataFrame:
    return rows.groupBy(group).agg(F.count("*").alias("passages"), F.min(n).alias("first"), F.max(n).alias("last"))


def challenge(points: Column, lines: Column, files: Column, high: Column | None = None, medium: Column | None = None) -> Column:
    """Challenge of 1 to 5: by points where there are any, else by labels, and 4 at least for a large change."""
    by_points = F.when(points >= 13, 5).when(points >= 8, 4).when(points >= 5, 3).when(points >= 3, 2).otherwise(1)
    by_label = F.when(high, 5).when(medium, 4).otherwise(2) if high is not None else F.lit(2)
    large = F.when((lines > 500) & (files > 10), F.greatest(by_label, F.lit(4))).otherwise(by_label)
    return F.when(points.isNotNull(), by_points).otherwise(large)


def contributors(facts: DataFrame, user: str) -> DataFrame:
    """Total of 2 a merge, 1 a hundred lines, 3 a review, 4 a bug, and 5 times the challenge; the lead has the largest.

    The most valuable is the one with the hardest item, then bugs, then reviews;
    where that is the lead, the next by total with an item or a bug, else the
    next by total.
    """
    s = facts.groupBy(user).agg(*(F.sum(c).alias(c) for c in ("prs", "lines", "reviews", "bugs", "challenge_total")), F.max("max_challenge").alias("max_challenge"))
    s = s.withColumn("total", F.round(F.col("prs") * 2 + F.col("lines") / 100 + F.col("reviews") * 3 + F.col("bugs") * 4 + F.col("challenge_total") * 5, 1))
    everyone = W.partitionBy()  # one row a user
    s = s.withColumn("rank", F.row_number().over(everyone.orderBy(F.desc("total"), user)))
    s = s.withColumn("_hard", F.row_number().over(everyone.orderBy(F.desc("max_challenge"), F.desc("bugs"), F.desc("reviews"), user)))
    fit = (F.col("rank") > 1) & ((F.col("max_challenge") > 0) | (F.col("bugs") > 0))
    next_fit = F.coalesce(F.min(F.when(fit, F.col("rank"))).over(everyone), F.min(F.when(F.col("rank") > 1, F.col("rank"))).over(everyone), F.lit(1))
    lead_is_hard = F.max((F.col("_hard") == 1) & (F.col("rank") == 1)).over(everyone)
    mvp = F.when(lead_is_hard, F.col("rank") == next_fit).otherwise(F.col("_hard") == 1)
    return s.withColumns({"is_lead": F.col("rank") == 1, "is_mvp": mvp}).drop("_hard")


def category(labels: Column, title: Column, bug: list[str], infra: list[str], feature: list[str]) -> Column:
    """Kind of an item by its labels, then by words of its title."""
    has = lambda names: F.arrays_overlap(labels, F.array(*map(F.lit, names)))
    t = F.lower(F.coalesce(title, F.lit("")))
    word = lambda names: F.rlike(t, F.lit("|".join(names)))
    return F.when(has(bug), "bug").when(has(infra), "infra").when(has(feature), "feature").when(word(["fix", "bug", "patch", "hotfix"]), "bug").when(word(["infra", "deploy", "ci", "refactor", "migrate", "performance"]), "infra").otherwise("feature")


def commit_days(commits: DataFrame, user: str, sha: str, ts: str, since: str, until: str) -> DataFrame:
    """Of each user the work days with a commit within a window that leaves out its end, commits taken once, and all that were seen."""
    first = commits.groupBy(user, sha).agg(F.min(ts).alias(ts))
    day = T.work_day(ts)
    inside = (day >= F.lit(since).cast("date")) & (day < F.lit(until).cast("date"))
    return first.withColumn("_d", F.when(inside, day)).groupBy(user).agg(F.count_distinct("_d").alias("days"), F.count("_d").alias("commits"), F.count("*").alias("unique_commits"))


def skipped_days(calendar: DataFrame, commits: DataFrame, users: DataFrame, user: str, credited: DataFrame | None = None) -> DataFrame:
    """Days without a commit of each user, those credited before left out: running it again adds none."""
    all_days = calendar.agg(F.collect_set("day").alias("_all"))  # one row
    worked = commits.groupBy(user).agg(F.collect_set("day").alias("_own"))  # at most the days that there are
    left = users.join(worked, user, "left").crossJoin(all_days)
    out = left.select(user, F.explode(F.array_except("_all", F.coalesce("_own", F.array().cast(dict(all_days.dtypes)["_all"])))).alias("day"))
    return out if credited is None else out.join(credited.select(user, "day"), [user, "day"], "left_anti")


def window_bounds(today: str, n: int) -> tuple[str, str]:
    """The ``n`` days before a day, as first day and excluded end."""
    from datetime import date, timedelta
    end = date.fromisoformat(today)
    return str(end - timedelta(days=n)), str(end)


def current_period(periods: DataFrame, today: str) -> DataFrame:
    """The period that holds a day, else the last that is over."""
    t = F.lit(today).cast("date")
    rows = periods.withColumn("_end", F.date_add("start", F.col("days"))).where(F.col("start") <= t)
    rank = F.when(F.col("_end") >= t, 0).otherwise(1)
    return rows.select("*", rank.alias("_r")).orderBy("_r", F.desc("start")).limit(1).drop("_r", "_end")


def story_points(fields: DataFrame, item: str) -> DataFrame:
    """The first numeric field of an item whose name speaks of points, size, estimate or effort."""
    hit = fields.where(F.rlike(F.lower("name"), F.lit("point|size|estimate|effort")) & F.col("number").isNotNull())
    return hit.groupBy(item).agg(F.min_by("number", "pos").alias("points"))


def batch_summary(rows: DataFrame, by: list[str], status: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *(F.sum((F.col(status) == s).cast("long")).alias(s) for s in ("ok", "skip", "abort")))


def catalogue(skills: DataFrame, bucket: str, repos: str) -> DataFrame:
    return skills.select(bucket, F.explode(repos).alias("repo")).groupBy(bucket, "repo").agg(F.count("*").alias("n"))


def package_union(chapters: DataFrame, column: str) -> DataFrame:
    return chapters.select(F.explode(column).alias("package")).distinct()


def digest_items(items: DataFrame, sections: list[str], priorities: list[str]) -> DataFrame:
    """Items with a known section and priority (the last of each list stands for any other), images once each, and the days their reporter wrote on."""
    pick = lambda c, known: F.when(F.col(c).isin(known), F.col(c)).otherwise(known[-1])
    rows = items.withColumns({"section": pick("section", sections), "priority": pick("priority", priorities), "images": F.array_distinct("images")})
    days = items.groupBy("reporter").agg(F.count_distinct(F.to_date("ts")).alias("reporter_days"))
    return rows.join(days, "reporter")


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
