"""Text built from rows: preview lists, prompts and heuristic summaries, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shortened(c: Column, size: int) -> Column:
    """A text of at most `size` characters, with an ellipsis where it was cut."""
    return F.when(F.length(c) > size, F.concat(F.rtrim(F.substring(c, 1, size - 1)), F.lit("…"))).otherwise(c)


def preview(items: Column, size: int, separator: str = "\n") -> Column:
    """The first `size` items on lines of their own, and how many more there are."""
    more = F.when(F.size(items) > size, F.concat(F.lit(separator), F.format_string("… %d more", F.size(items) - size))).otherwise("")
    return F.concat(F.array_join(F.slice(items, 1, size), separator), more)


def padded(items: Column, size: int, filler: str) -> Column:
    """Distinct items in their order, `size` of them, filled up."""
    own = F.slice(F.array_distinct(items), 1, size)
    return F.concat(own, F.array_repeat(F.lit(filler), F.lit(size) - F.size(own)))


def page_prompt(name: Column, title: Column, text: Column, links: Column, size: int = 1200, most: int = 40) -> Column:
    """What a model is asked about a page: whose it is, how it begins and where it leads."""
    each = F.transform(F.slice(links, 1, most), lambda x: F.concat(F.lit("- "), F.coalesce(x["anchor"], F.lit("")), F.lit(" -> "), x["url"]))
    return F.concat(F.lit("Person: "), name, F.lit("\nTitle: "), F.coalesce(title, F.lit("")), F.lit("\nText: "), shortened(F.coalesce(text, F.lit("")), size), F.lit("\nLinks:\n"), F.array_join(each, "\n"))


def recent_titles(papers: DataFrame, key: str = "person", size: int = 8) -> DataFrame:
    """The latest titles of each person, newest first, as one array."""
    w = Window.partitionBy(key).orderBy(F.desc("year"), "title")
    latest = papers.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= size)
    return latest.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_rk", "title", "venue", "year"))), lambda x: F.format_string("%s (%s %d)", x["title"], x["venue"], x["year"])).alias("titles"))


def summary(name: Column, university: Column, areas: Column, venues: Column, papers: Column) -> Column:
    """Two sentences on a person: what they work on, and how much they published where."""
    top = F.array_join(F.slice(areas, 1, 3), ", ")
    where = F.array_join(F.slice(venues, 1, 3), ", ")
    work = F.when(F.size(areas) > 0, F.concat(F.lit(" works on "), top)).otherwise(F.lit(" has no dominant area"))
    at = F.when(university.isNotNull() & (university != ""), F.concat(F.lit(" at "), university)).otherwise("")
    much = F.when(papers >= 20, F.lit("a prolific author")).when(papers >= 5, F.lit("an active author")).otherwise(F.lit("an author"))
    return F.concat(name, at, work, F.lit(". They are "), much, F.format_string(" of %d papers", papers), F.when(F.size(venues) > 0, F.concat(F.lit(", mostly in "), where)).otherwise(""), F.lit("."))
