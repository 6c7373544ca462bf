"""Bibliographic operators: counts, evidence, scores and rankings of people by their papers.

A paper row is (person, paper, venue, year, title); each function takes and returns DataFrames and names its columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.roster import alias_match
from tidewater.storage import blocks, small


def exploded_authors(papers: DataFrame, authors: str = "authors") -> DataFrame:
    """A row for each author of each paper; `authors` is an array of structs (pid, name)."""
    return papers.withColumn("_author", F.explode(authors)).select("*", F.col("_author.pid").alias("pid"), F.col("_author.name").alias("person")).drop("_author", authors)


def counts(papers: DataFrame, key: str = "person") -> DataFrame:
    """Papers, distinct venues and distinct years.  Spark's own plan for two distinct counts forgets how its input is partitioned and
    shuffles several rows for each paper; here papers that are partitioned by the key stay in their task."""
    of = lambda c: F.struct(F.lit(c).alias("of"), F.col(c).cast("string").alias("is"))
    each = papers.select(key, F.explode(F.array(of("venue"), of("year"))).alias("_x")).groupBy(key, F.col("_x.of").alias("of"), F.col("_x.is").alias("is")).agg(F.count(F.lit(1)).alias("n"))
    known = lambda c: F.count_if((F.col("of") == c) & F.col("is").isNotNull())
    return each.groupBy(key).agg(F.sum(F.when(F.col("of") == "venue", F.col("n"))).alias("papers"), known("venue").alias("venues"), known("year").alias("years"))


def venue_histogram(papers: DataFrame, key: str = "person", top: int | None = None) -> DataFrame:
    """(key, venue, n, rk): venues by frequency, equal ones by name, no name last."""
    by = papers.groupBy(key, "venue").agg(F.count(F.lit(1)).alias("n"))
    ranked = by.withColumn("rk", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), F.asc_nulls_last("venue"))))
    return ranked if top is None else ranked.where(F.col("rk") <= top)


def activity(papers: DataFrame, key: str = "person", cap: float = 5.0, points: float = 4.0) -> DataFrame:
    """First and last year, span in years and capped productivity."""
    span = F.max("year") - F.min("year") + 1
    out = papers.groupBy(key).agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), span.alias("span"), F.count(F.lit(1)).alias("papers"))
    return out.withColumn("productivity", F.round(F.least(F.col("papers").cast("double") / F.col("span"), F.lit(cap)) * points, 4))


def weighted_venues(papers: DataFrame, weights: DataFrame, key: str = "person", default: float = 1.0, caps: dict[str, float] | None = None) -> DataFrame:
    """Sum of venue weights (venue, weight), a default for the others, under each named cap."""
    joined = papers.join(small(weights, 128), "venue", "left")
    total = F.sum(F.coalesce("weight", F.lit(default)))
    return joined.groupBy(key).agg(total.alias("raw"), *(F.least(total, F.lit(cap)).alias(name) for name, cap in (caps or {"venue_score": 25.0}).items()))


def affinity(papers: DataFrame, favoured: list[str], key: str = "person", aliases: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """The share of papers in favoured venues; with `aliases`, of papers whose venue is one by `roster.alias_match`."""
    venue = alias_match(F.col("venue"), aliases) if aliases else F.col("venue")
    hits = F.count_if(venue.isin(*favoured))
    return papers.groupBy(key).agg(hits.alias("hits"), F.count(F.lit(1)).alias("papers"), F.round(hits.cast("double") / F.count(F.lit(1)), 4).alias("affinity"))


def keyword_evidence(titles: DataFrame, taxonomy: DataFrame, weight: float = 3.0) -> DataFrame:
    """A row for each keyword of the taxonomy (category, term) that a title contains."""
    found = [titles.join(some, F.lower("title").contains(F.col("term"))) for some in blocks(taxonomy, 512)]
    return reduce(DataFrame.unionByName, found).withColumn("weight", F.lit(weight))


def venue_evidence(papers: DataFrame, taxonomy: DataFrame, weight: float = 2.0) -> DataFrame:
    """A row for each paper whose venue a taxonomy (category, venue_term) names."""
    return papers.join(taxonomy, F.upper("venue") == F.upper("venue_term")).drop("venue_term").withColumn("weight", F.lit(weight))


def profile(evidence: DataFrame, key: str) -> DataFrame:
    """Category scores of each key, their share of the key's largest, and their rank."""
    sums = evidence.groupBy(key, "category").agg(F.sum("weight").alias("score"))
    w = Window.partitionBy(key)
    return sums.withColumn("share", F.round(F.col("score") / F.max("score").over(w), 4)).withColumn("rk", F.row_number().over(w.orderBy(F.desc("score"), "category")))


def ranked(scores: DataFrame, by: list[Column], top: int | None = None) -> DataFrame:
    """1-based rank in the order of `by`, which must end in a unique key.  A top-k is cut before it is numbered, so one task numbers k rows."""
    rows = scores.orderBy(*by)
    if top is not None:
        rows = rows.limit(top)
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(*by)))


def overall(papers: Column, venue_score: Column, areas: Column, share: Column, papers_cap: float, areas_cap: float = 5.0) -> Column:
    """30 points for papers, the venue score, 15 points for breadth and 30 for affinity."""
    return F.lit(30.0) * F.least(papers.cast("double"), F.lit(papers_cap)) / papers_cap + venue_score + F.lit(15.0) * F.least(areas.cast("double"), F.lit(areas_cap)) / areas_cap + F.lit(30.0) * share


def legacy(papers: Column, venue_score: Column, areas: Column, papers_cap: float, areas_cap: float = 5.0) -> Column:
    """The earlier formula: 40 points for papers, the venue score up to 30, 30 points for breadth."""
    return F.lit(40.0) * F.least(papers.cast("double"), F.lit(papers_cap)) / papers_cap + venue_score + F.lit(30.0) * F.least(areas.cast("double"), F.lit(areas_cap)) / areas_cap


def priority(score: Column, bounds: tuple[float, float, float] = (80.0, 60.0, 40.0)) -> Column:
    return F.when(score >= bounds[0], "P0").when(score >= bounds[1], "P1").when(score >= bounds[2], "P2").otherwise("P3")


def deduplicated(rows: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """One row for each coalesced key: the first in `order`."""
    w = Window.partitionBy(F.coalesce(*keys)).orderBy(*order)
    return rows.withColumn("_rk", F.row_number().over(w)).where("_rk = 1").drop("_rk")
