"""Quality reports over runs of the page intelligence: a row for each person and run with what was fetched, found and parsed.

A run row is (name, homepage, fetch_status, navigation_success, depth, confidence, current_members, former_members, raw_members, pages, errors).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.text import banded, rate
from tidewater.operators.sequences import upper_median

#: What failed, in order: the first that holds counts.
FAILURES: list[tuple[str, str]] = [
    ("no_homepage", "homepage is null or homepage = ''"), ("fetch_failed", "fetch_status <> 'ok'"), ("navigation_failed", "not navigation_success"), ("no_pages", "pages = 0"), ("no_members", "current_members + former_members = 0"),
    ("only_former", "current_members = 0"),
]
FIXES = {
    "no_homepage": "find a homepage", "fetch_failed": "retry, or follow redirects", "navigation_failed": "widen the link rules", "no_pages": "explore one step further", "no_members": "add a layout", "only_former": "look for a current list",
}


def failure(ladder: list[tuple[str, str]] = FAILURES, rest: str = "ok") -> Column:
    out = F.lit(rest)
    for name, test in reversed(ladder):
        out = F.when(F.expr(test), name).otherwise(out)
    return out


def failures(runs: DataFrame, examples: int = 5) -> DataFrame:
    """(category, n, share, examples, fix): how often each failure occurs, with the first names of each."""
    named = runs.withColumn("category", failure())
    first = named.withColumn("_rk", F.row_number().over(Window.partitionBy("category").orderBy("name")))
    by = first.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.when(F.col("_rk") <= examples, F.col("name")))).alias("examples"))
    fix = F.create_map(*[F.lit(x) for pair in FIXES.items() for x in pair])
    return by.withColumn("share", F.round(F.col("n").cast("double") / F.sum("n").over(Window.partitionBy()), 4)).withColumn("fix", fix[F.col("category")])


def metrics(runs: DataFrame) -> DataFrame:
    """One row of counts, rates, means and medians of a run."""
    n, fetched = F.count(F.lit(1)), F.count_if(F.col("fetch_status") == "ok")
    navigated, found = F.count_if("navigation_success"), F.count_if(F.expr("current_members + former_members > 0"))
    members = F.sum(F.col("current_members") + F.col("former_members"))
    return runs.agg(
        n.alias("people"), F.count_if(F.expr("homepage is not null and homepage <> ''")).alias("with_homepage"), fetched.alias("fetched"), navigated.alias("navigated"), found.alias("with_members"), rate(fetched, n).alias("fetch_rate"),
        rate(navigated, n).alias("navigation_rate"), rate(found, n).alias("member_rate"), members.alias("members"), F.sum("current_members").alias("current"), F.sum("former_members").alias("former"),
        F.round(F.avg("current_members"), 4).alias("mean_current"), upper_median("current_members").alias("median_current"), F.max("current_members").alias("most_current"), F.round(F.avg("depth"), 4).alias("mean_depth"),
        F.round(F.avg("confidence"), 4).alias("mean_confidence"), F.round(F.avg("pages"), 4).alias("mean_pages"), rate(F.sum("raw_members") - members, F.sum("raw_members")).alias("dedup_rate"),
    )


def member_bands(runs: DataFrame) -> DataFrame:
    return runs.groupBy(banded(F.col("current_members"), [("0", 0), ("1-5", 5), ("6-20", 20), ("21-50", 50)], "50+").alias("band")).agg(F.count(F.lit(1)).alias("n"))


def confidence_bands(rows: DataFrame, column: str = "confidence") -> DataFrame:
    c = F.col(column)
    band = F.when(c >= 0.8, "high").when(c >= 0.6, "good").when(c >= 0.4, "fair").otherwise("low")
    return rows.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(c), 4).alias("mean"))


def error_prefixes(runs: DataFrame) -> DataFrame:
    """Errors by what stands before their colon."""
    return runs.select(F.explode("errors").alias("e")).groupBy(F.trim(F.split_part("e", F.lit(":"), F.lit(1))).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def changes(old: DataFrame, new: DataFrame, top: int = 20) -> DataFrame:
    """The people whose current members changed most between two runs, and how: newly found, newly lost, gained, lost."""
    a, b = old.select("name", F.col("current_members").alias("before")), new.select("name", F.col("current_members").alias("after"))
    both = a.join(b, "name").withColumn("delta", F.col("after") - F.col("before")).where("delta <> 0")
    kind = F.when((F.col("before") == 0) & (F.col("after") > 0), "newly_found").when((F.col("before") > 0) & (F.col("after") == 0), "newly_lost").when(F.col("delta") > 0, "gained").otherwise("lost")
    return both.withColumn("change", kind).orderBy(F.desc(F.abs("delta")), "name").limit(top)


def transitions(old: DataFrame, new: DataFrame) -> DataFrame:
    """(before, after, n): what became of each failure of the earlier run."""
    a, b = old.select("name", failure().alias("before")), new.select("name", failure().alias("after"))
    return a.join(b, "name", "left").groupBy("before", F.coalesce("after", F.lit("missing")).alias("after")).agg(F.count(F.lit(1)).alias("n"))


def by_group(runs: DataFrame, group: str, separator: str | None = None, default: str = "(unknown)") -> DataFrame:
    """A run's figures for each university or venue; a text of several values counts for each of them."""
    value = F.coalesce(F.when(F.trim(group) != "", F.col(group)), F.lit(default))
    rows = runs.withColumn("_g", F.explode(F.transform(F.split(value, separator), lambda x: F.trim(x))) if separator else value)
    return rows.groupBy(F.col("_g").alias(group)).agg(F.count(F.lit(1)).alias("people"), F.count_if("navigation_success").alias("navigated"), F.sum("current_members").alias("current"), rate(F.count_if("navigation_success"), F.count(F.lit(1))).alias("rate"))


def same_members(old: DataFrame, new: DataFrame) -> DataFrame:
    """(person, same): whether two runs found the very same members; rows are (person, member)."""
    sets = lambda d, c: d.groupBy("person").agg(F.sort_array(F.collect_set(F.lower("member"))).alias(c))
    return sets(old, "a").join(sets(new, "b"), "person", "full_outer").select("person", F.col("a").eqNullSafe(F.col("b")).alias("same"))


def assembled(people: DataFrame, homepages: DataFrame, members: DataFrame) -> DataFrame:
    """A row for each person with homepage, status (success, skipped, failed), member count and members; nothing is dropped."""
    found = members.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("member")).alias("members"))
    out = people.join(homepages, "name", "left").join(found, "name", "left")
    status = F.when(F.col("homepage").isNull(), "skipped").when(F.col("fetch_status") != "ok", "failed").otherwise("success")
    return out.withColumns({"status": status, "n": F.coalesce("n", F.lit(0)), "members": F.coalesce("members", F.array().cast("array<string>"))})


def chained(rows: DataFrame, steps: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Analyzers or enrichers, functions of a DataFrame, applied one after the other."""
    for step in steps:
        rows = rows.transform(step)
    return rows


def answered(rows: DataFrame, provider: Callable[[str], str | None], prompt: str, answer: str, fallback: Column) -> DataFrame:
    """`answer` from a provider of text (a model, a stub) for each prompt; where it has none or fails, the fallback."""
    def one(text: str | None) -> str | None:
        try:
            return None if text is None else provider(text)
        except Exception:  # noqa: BLE001  a provider may fail in any way; the fallback stands in
            return None

    @F.pandas_udf("string")
    def ask(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return rows.withColumn(answer, F.coalesce(ask(F.col(prompt)), fallback))
