"""The driver's tables as papers, people and other inputs of the operators, and the rule tables that its data can match."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.storage import joined, tasks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers(spark: SparkSession, sf_dir: str, by: str | None = None) -> DataFrame:
    """(person, paper, venue, year, title): the distinct brands of each customer's orders; the title is the first part's name.  Tasks take
    so many lines each, and with `by` the papers of a value of that column are in one of as many partitions."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    n = tasks(lines)
    rows = joined(lines, parts, "l_partkey", "p_partkey", n, 128).repartition(n, "l_orderkey").join(orders.repartition(n, "o_orderkey").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    out = rows.groupBy(F.col("o_custkey").alias("person"), F.col("o_orderkey").alias("paper"), F.col("p_brand").alias("venue")).agg(F.min("year").alias("year"), F.min("p_name").alias("title"))
    return out.repartition(n, by) if by else out


PAPERS_SQL = """papers AS (
  SELECT o_custkey AS person, o_orderkey AS paper, p_brand AS venue, CAST(min(year(o_orderdate)) AS INTEGER) AS year, min(p_name) AS title
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)"""

WEIGHTS = {**{f"Brand#{i}": 2.0 for i in range(1, 6)}, **{f"Brand#{i}": 1.5 for i in range(6, 11)}}
FAVOURED = ["Brand#1", "Brand#12", "Brand#13", "Brand#14"]
TAXONOMY = [("fastening", "bolt"), ("fastening", "rod"), ("motion", "gear"), ("motion", "ring"), ("surface", "plate"), ("surface", "anvil"), ("device", "widget"), ("device", "gizmo")]
ALIASES = {f"Brand#{i}": f"Brand#{i - 20}" for i in range(21, 26)}


def weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(WEIGHTS.items()), "venue string, weight double")


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TAXONOMY, "category string, term string")


def values(rows: list[tuple]) -> str:
    """Rows as an SQL VALUES list."""
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else f"CAST({x} AS DOUBLE)" if isinstance(x, float) else str(x) for x in r) + ")" for r in rows)


WEIGHTS_SQL = f"weights(venue, weight) AS (VALUES {values(list(WEIGHTS.items()))})"
TAXONOMY_SQL = f"taxonomy(category, term) AS (VALUES {values(TAXONOMY)})"
FAVOURED_SQL = ", ".join(f"'{x}'" for x in FAVOURED)
