"""Link graphs and runs at rest: JSON with defaults, decision logs, graph tables, person records and run reports."""

from __future__ import annotations

import resource
import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

GRAPH = "struct<url:string,title:string,status:string,nodes:array<struct<url:string,anchor:string,node_type:string,confidence:double>>>"
PERSON = "struct<author:array<string>,url:array<string>,note:array<string>>"


def graph_of(text: Column) -> Column:
    """A graph from JSON: what is missing gets its default (status unknown, no nodes, node type unknown, confidence 0); null for text that is
    no JSON object."""
    g = F.from_json(text, GRAPH)
    node = lambda n: F.struct(n["url"].alias("url"), F.coalesce(n["anchor"], F.lit("")).alias("anchor"), F.coalesce(n["node_type"], F.lit("unknown")).alias("node_type"), F.coalesce(n["confidence"], F.lit(0.0)).alias("confidence"))
    nodes = F.coalesce(F.transform(g["nodes"], node), F.from_json(F.lit("[]"), "array<struct<url:string,anchor:string,node_type:string,confidence:double>>"))
    return F.when(F.trim(text).startswith("{") & g.isNotNull(), F.struct(g["url"].alias("url"), F.coalesce(g["title"], F.lit("")).alias("title"), F.coalesce(g["status"], F.lit("unknown")).alias("status"), nodes.alias("nodes")))


def graphs(pages: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """A row for each page (key, url, status) with its nodes in order: the page itself first, its links (key, pos, anchor, url, node_type,
    confidence) behind.  A page whose status isn't ok has itself alone, as a failure of no confidence."""
    own = links.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "url", "anchor", "node_type", "confidence"))).alias("_l"))
    ok = F.col("status") == "ok"
    first = F.struct(F.lit(-1).cast(dict(links.dtypes)["pos"]).alias("pos"), F.col("url"), F.lit("").alias("anchor"), F.when(ok, "homepage").otherwise("failure").alias("node_type"), F.when(ok, 1.0).otherwise(0.0).alias("confidence"))
    rest = F.when(ok & F.col("_l").isNotNull(), F.col("_l")).otherwise(F.slice(F.array(first), 2, 1))
    return pages.join(own, key, "left").select(key, "url", "status", F.concat(F.array(first), rest).alias("nodes"))


def write_graphs(df: DataFrame, path: str, key: str) -> None:
    """Nodes as a table by type, for any size, and how many of each type there are as one small JSON file folder."""
    nodes = df.select(key, F.explode("nodes").alias("n")).select(key, "n.*")
    nodes.write.mode("overwrite").partitionBy("node_type").parquet(f"{path}/nodes")
    nodes.groupBy("node_type").agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg("confidence"), 3).alias("confidence")).coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def log_decisions(df: DataFrame, path: str, run: str) -> None:
    """Appends decisions to the log, those of a run in a part of their own; a run that is logged again replaces its part."""
    df.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def write_candidates(df: DataFrame, path: str, keys: list[str], order: list[Column]) -> DataFrame:
    """Identity candidates, the best of each key, as a table; returns how many there are of each state."""
    from tidewater.operators.matching import best_record

    best_record(df, keys, order).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def person(xml: Column) -> Column:
    """(name, names, homepage, affiliations) of a person's record; the homepage is the first url."""
    p = F.from_xml(xml, PERSON)
    return F.struct(F.get(p["author"], 0).alias("name"), p["author"].alias("names"), F.get(p["url"], 0).alias("homepage"), p["note"].alias("affiliations"))


def proceedings(papers: DataFrame, keys: list[str]) -> DataFrame:
    """Proceedings from papers: their keys, how many papers and their titles in order; there are none without papers."""
    return papers.groupBy(*keys).agg(F.count(F.lit(1)).alias("papers"), F.sort_array(F.collect_list("title")).alias("titles"))


def reported(df: DataFrame, path: str, checks: dict[str, Column]) -> dict[str, float]:
    """Writes a table and returns what the run took: rows, how many break each check, seconds and the driver's peak memory in MB.  The
    figures are gathered while the rows are written, without a second pass."""
    seen, began = Observation(), time.perf_counter()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()]).write.mode("overwrite").parquet(path)
    return dict(seen.get) | {"seconds": time.perf_counter() - began, "peak_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024}


def namespaced(pages: DataFrame, namespace: str) -> DataFrame:
    """Pages of one of several fetches, told apart by a column; an address that is fetched for two namespaces is kept for both."""
    return pages.withColumn("namespace", F.lit(namespace))


def fetched(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """Requests (url) with the page that a table of pages (url, html) has for them: status ok, empty (a blank page), missing, or invalid (no
    http address)."""
    from tidewater.functions.text import fetchable, url_key

    held = pages.groupBy(url_key(F.col("url")).alias("_k")).agg(F.min("html").alias("html")).where("_k is not null")
    out = requests.withColumn("_q", url_key(fetchable(F.col("url")))).join(held, F.col("_q") == F.col("_k"), "left")
    status = F.when(F.col("_q").isNull(), "invalid").when(F.col("_k").isNull(), "missing").when(F.trim(F.coalesce("html", F.lit(""))) == "", "empty").otherwise("ok")
    return out.withColumn("status", status).drop("_q", "_k")


def top(df: DataFrame, n: int = 20) -> str:
    """The first rows as text, for a console."""
    return df._jdf.showString(n, 60, False)

