"""Queries of the report aggregates, the ordered-row operators and the graph operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions.text import banded, first_rule, rate
from tidewater.operators import graph, matching, sequences
from tidewater.plans.tables import table
from tidewater.streaming import windows

def _if(test: str) -> Column:
    return F.count_if(F.expr(test))


_BANDS = [("0", 0), ("1-5", 5), ("6-20", 20), ("21-50", 50)]


def role_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [("student", "^(HOUSEHOLD|FURNITURE)$"), ("faculty", "^BUILDING$")]
    rows = table(spark, sf_dir, "customer").groupBy(first_rule(F.col("c_mktsegment"), rules, "industry").alias("role")).agg(F.count(F.lit(1)).alias("n"))
    total = table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("total"))
    return rows.crossJoin(F.broadcast(total)).select("role", "n", F.round(F.col("n") * 100.0 / F.col("total"), 1).alias("pct"))


def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.round("s_acctbal").cast("long").alias("v"))
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("v").cast("double") / F.count(F.lit(1)), 4).alias("mean"), sequences.upper_median("v").alias("upper_median"), F.min("v").alias("low"), F.max("v").alias("high"),
        _if("v >= 8000").alias("at_8000"), _if("v >= 6000 and v < 8000").alias("at_6000"), _if("v >= 4000 and v < 6000").alias("at_4000"), _if("v < 4000").alias("below"),
    )


def upper_vs_true_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", F.floor("o_totalprice").alias("v"))
    return rows.groupBy("o_orderpriority").agg(sequences.upper_median("v").alias("upper_median"), F.percentile("v", F.lit(0.5)).alias("median"))


def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.groupBy("event_type").agg(F.round(F.avg(F.floor("value")), 4).alias("mean"), F.round(F.percentile("value", F.lit(0.95)), 4).alias("p95"), _if("value > 100").alias("slow"), F.count(F.lit(1)).alias("n"))


def status_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count(F.lit(1))
    fetched, done, large = _if("o_orderstatus <> 'P'"), _if("o_orderstatus = 'F'"), _if("o_orderstatus = 'F' and o_totalprice >= 250000")
    return table(spark, sf_dir, "orders").agg(n.alias("total"), fetched.alias("fetched"), done.alias("done"), large.alias("large"), rate(fetched, n).alias("fetched_rate"), rate(done, fetched).alias("done_rate"), rate(large, done).alias("large_rate"))


def reason_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def count_histogram_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    each = table(spark, sf_dir, "customer").select("c_custkey").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return each.groupBy(banded(F.coalesce("n", F.lit(0)), _BANDS, "50+").alias("band")).agg(F.count(F.lit(1)).alias("people"))


def source_count_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.countDistinct("l_suppkey").alias("sources"))
    return each.groupBy("sources").agg(F.count(F.lit(1)).alias("n"))


def dedup_rate_two_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    raw, kept, repeated = F.sum("n"), F.count(F.lit(1)), _if("n > 1")
    return each.agg(raw.alias("raw"), kept.alias("kept"), rate(raw - kept, raw).alias("removed_rate"), rate(repeated, kept).alias("repeated_rate"))


def coverage_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_mktsegment", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"), F.when(F.col("c_nationkey") > 4, F.col("c_nationkey")).alias("nation"))
    n = F.count(F.lit(1))
    return rows.groupBy("c_mktsegment").agg(n.alias("n"), F.count("balance").alias("with_balance"), F.count("nation").alias("with_nation"), rate(F.count("balance"), n).alias("balance_rate"), rate(F.count("nation"), n).alias("nation_rate"))


def having_top_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    by = rows.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.floor("s_acctbal")).cast("double") / F.count(F.lit(1)), 4).alias("mean")).where("n >= 2")
    top = by.orderBy(F.desc("mean"), "n_name").limit(5).withColumn("side", F.lit("top"))
    return top.unionByName(by.orderBy("mean", "n_name").limit(5).withColumn("side", F.lit("bottom")))


def split_explode_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.explode(F.split(F.when(F.col("p_size") > 5, F.col("p_name")), " ")).alias("token"), "p_size")
    other = table(spark, sf_dir, "part").where("p_size <= 5").select(F.lit("(none)").alias("token"), "p_size")
    return rows.unionByName(other).groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"))


_LADDER = [("urgent_open", "o_orderpriority = '1-URGENT' and o_orderstatus = 'O'"), ("partial", "o_orderstatus = 'P'"), ("small", "o_totalprice < 50000"), ("low", "o_orderpriority = '5-LOW'")]


def _category():
    out = F.lit("ok")
    for name, test in reversed(_LADDER):
        out = F.when(F.expr(test), F.lit(name)).otherwise(out)
    return out


def failure_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(_category().alias("category")).agg(F.count(F.lit(1)).alias("n"))


def bottleneck_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = table(spark, sf_dir, "orders").groupBy(_category().alias("category")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()
    out = by.withColumn("share", F.round(F.col("n").cast("double") / F.sum("n").over(whole), 4)).where("category <> 'ok'")
    return out.withColumn("rk", F.row_number().over(Window.orderBy(F.desc("n"), "category")))


def state_counts_with_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = spark.createDataFrame([("F",), ("O",), ("P",), ("X",)], "state string")
    by = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return states.join(by, F.col("state") == F.col("o_orderstatus"), "left").select("state", F.coalesce("n", F.lit(0)).alias("n"))


def identity_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    late = F.struct("o_orderdate", "o_orderkey")
    return orders.groupBy("o_custkey").agg(
        F.max_by(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")), F.when(F.col("o_orderstatus") == "F", late)).alias("last_done"), F.max(F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("state"),
        F.max("o_totalprice").alias("confidence"), F.min("o_orderdate").alias("created"),
    )


def best_record_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc(F.col("o_orderstatus") == "F"), F.desc("o_totalprice"), F.asc("o_orderkey")]
    return matching.best_record(table(spark, sf_dir, "orders"), ["o_custkey"], order).select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


def examples_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.top_per_group(table(spark, sf_dir, "part").select("p_type", "p_partkey", "p_name"), ["p_type"], [F.asc("p_partkey")], 5)


def adjacent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.runs(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", ["event_id"], "event_type").select("user_id", "event_type", "n", "first", "last")


def rolling_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.rolling(table(spark, sf_dir, "conversations"), "conv_id", ["turn", "role", "text"], "text").select("conv_id", "turn", "in_window", "window_chars")


def carry_forward_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sequences.carried(table(spark, sf_dir, "conversations"), "conv_id", ["turn", "role", "text"], F.when(F.col("role") == "user", F.col("turn")))
    return out.select("conv_id", "turn", "role", "section")


def invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    orphans = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").agg(F.count(F.lit(1)).alias("violations")).select(F.lit("line_without_order").alias("name"), "violations")
    nulls = orders.agg(_if("o_custkey is null or o_orderdate is null").alias("violations")).select(F.lit("null_field").alias("name"), "violations")
    twice = orders.groupBy("o_orderkey").count().where("count > 1").agg(F.count(F.lit(1)).alias("violations")).select(F.lit("order_key_twice").alias("name"), "violations")
    bad = lines.agg(_if("l_quantity <= 0 or l_discount < 0 or l_discount > 1").alias("violations")).select(F.lit("value_out_of_range").alias("name"), "violations")
    return orphans.unionByName(nulls).unionByName(twice).unionByName(bad)


def key_prefix_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def multi_key_review_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", (F.col("c_acctbal") < 0).alias("broke"), (F.col("c_nationkey") < 5).alias("near"), "c_nationkey")
    # Every row is numbered: by range, so that no single task sorts all of them.
    keys = ["broke", "near", "c_nationkey"]
    order = [F.desc("broke"), F.asc("near"), F.asc("c_nationkey")]
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    groups = groups.withColumn("ahead", F.coalesce(F.sum("n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lower("c_name"), "c_custkey"))
    x, y = rows.withColumn("within", within).alias("x"), F.broadcast(groups).alias("y")
    both = x.join(y, F.expr(" and ".join(f"x.{k} <=> y.{k}" for k in keys)))
    return both.select((F.col("ahead") + F.col("within")).cast("int").alias("rank"), "x.c_custkey", "x.broke", "x.near", "x.c_nationkey").orderBy("rank")


def adaptive_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    n = F.count(F.lit(1)).over(Window.partitionBy("l_orderkey"))
    capped = lines.withColumn("cap", F.when(n >= 7, 2).when(n >= 4, 3).otherwise(n.cast("int"))).withColumn("rk", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_partkey", "l_suppkey", "l_linenumber")))
    return capped.where("rk <= cap").select("l_orderkey", "l_partkey", "l_suppkey", "rk", "cap")


#: Nodes of each root in `bfs_page_budget`, as many as the reference visits pages.
PAGES = 150


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers to their nation and back to every customer of the nation, so that there are cycles."""
    there = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1000).alias("src"), F.col("c_nationkey").cast("long").alias("dst"))
    return there.unionByName(there.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def bounded_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = spark.createDataFrame([(1000,), (1001,), (1002,)], "root long")
    return graph.bounded_bfs(_edges(spark, sf_dir), roots, 3)


def bfs_page_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = spark.createDataFrame([(1000,), (1001,), (1002,)], "root long")
    return graph.budgeted(graph.bounded_bfs(_edges(spark, sf_dir), roots, 3), PAGES)


def graph_branching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.branching(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")))


def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_counts(table(spark, sf_dir, "events"), "1 hour").select("start", "event_type", "n", "value")


QUERIES = {f.__name__: f for f in (
    role_estimates, score_distribution, upper_vs_true_median, latency_percentiles, status_funnel, reason_prefix_counts, count_histogram_bands, source_count_histogram, dedup_rate_two_ways, coverage_rates, having_top_bottom,
    split_explode_report, failure_ladder, bottleneck_rank, state_counts_with_zeros, identity_merge, best_record_per_key, examples_per_group, adjacent_runs, rolling_context, carry_forward_section, invariants, key_prefix_freq,
    multi_key_review_sort, adaptive_cap, bounded_bfs, bfs_page_budget, graph_branching, stream_window_counts,
)}

_LADDER_SQL = "CASE " + " ".join(f"WHEN {t} THEN '{n}'" for n, t in _LADDER) + " ELSE 'ok' END"
_BFS_SQL = """WITH RECURSIVE near AS (SELECT c_custkey + 1000 AS a, CAST(c_nationkey AS BIGINT) AS b FROM customer),
edges AS (SELECT a AS src, b AS dst FROM near UNION SELECT b, a FROM near),
walk(root, node, depth) AS (SELECT r, r, 0 FROM (VALUES (CAST(1000 AS BIGINT)), (CAST(1001 AS BIGINT)), (CAST(1002 AS BIGINT))) v(r) UNION SELECT root, dst, depth + 1 FROM walk JOIN edges ON node = src WHERE depth < 3),
found AS (SELECT root, node, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY 1, 2)"""
SQL = {
    "role_estimates": "WITH r AS (SELECT CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'student' WHEN c_mktsegment = 'BUILDING' THEN 'faculty' ELSE 'industry' END AS role, count(*) AS n FROM customer GROUP BY 1) SELECT role, n, round(n * CAST(100 AS DOUBLE) / (SELECT count(*) FROM customer), 1) AS pct FROM r",
    "score_distribution": """WITH v AS (SELECT CAST(round(s_acctbal) AS BIGINT) AS v FROM supplier), o AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM v)
SELECT count(*) AS n, round(CAST(sum(v) AS DOUBLE) / count(*), 4) AS mean, max(v) FILTER (WHERE i = n // 2) AS upper_median, min(v) AS low, max(v) AS high, count(*) FILTER (WHERE v >= 8000) AS at_8000,
  count(*) FILTER (WHERE v >= 6000 AND v < 8000) AS at_6000, count(*) FILTER (WHERE v >= 4000 AND v < 6000) AS at_4000, count(*) FILTER (WHERE v < 4000) AS below FROM o""",
    "upper_vs_true_median": """WITH v AS (SELECT o_orderpriority, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders), o AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM v)
SELECT o_orderpriority, max(v) FILTER (WHERE i = n // 2) AS upper_median, quantile_cont(CAST(v AS DOUBLE), 0.5) AS median FROM o GROUP BY 1""",
    "latency_percentiles": "SELECT event_type, round(avg(floor(value)), 4) AS mean, round(quantile_cont(value, 0.95), 4) AS p95, count(*) FILTER (WHERE value > 100) AS slow, count(*) AS n FROM events GROUP BY 1",
    "status_funnel": """WITH c AS (SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus <> 'P') AS fetched, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_orderstatus = 'F' AND o_totalprice >= 250000) AS large FROM orders)
SELECT *, round(CAST(fetched AS DOUBLE) / greatest(total, 1), 4) AS fetched_rate, round(CAST(done AS DOUBLE) / greatest(fetched, 1), 4) AS done_rate, round(CAST(large AS DOUBLE) / greatest(done, 1), 4) AS large_rate FROM c""",
    "reason_prefix_counts": "SELECT split_part(o_orderpriority, '-', 1) AS prefix, count(*) AS n FROM orders GROUP BY 1",
    "count_histogram_bands": "WITH e AS (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1) SELECT CASE WHEN n <= 0 THEN '0' WHEN n <= 5 THEN '1-5' WHEN n <= 20 THEN '6-20' WHEN n <= 50 THEN '21-50' ELSE '50+' END AS band, count(*) AS people FROM e GROUP BY 1",
    "source_count_histogram": "WITH e AS (SELECT l_orderkey, l_linenumber, count(DISTINCT l_suppkey) AS sources FROM lineitem GROUP BY 1, 2) SELECT sources, count(*) AS n FROM e GROUP BY 1",
    "dedup_rate_two_ways": "WITH e AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber), s AS (SELECT CAST(sum(n) AS BIGINT) AS raw, count(*) AS kept, count(*) FILTER (WHERE n > 1) AS twice FROM e) SELECT raw, kept, round(CAST(raw - kept AS DOUBLE) / raw, 4) AS removed_rate, round(CAST(twice AS DOUBLE) / kept, 4) AS repeated_rate FROM s",
    "coverage_rates": "WITH c AS (SELECT c_mktsegment, count(*) AS n, count(*) FILTER (WHERE c_acctbal > 0) AS with_balance, count(*) FILTER (WHERE c_nationkey > 4) AS with_nation FROM customer GROUP BY 1) SELECT *, round(CAST(with_balance AS DOUBLE) / n, 4) AS balance_rate, round(CAST(with_nation AS DOUBLE) / n, 4) AS nation_rate FROM c",
    "having_top_bottom": """WITH b AS (SELECT n_name, count(*) AS n, round(CAST(sum(CAST(floor(s_acctbal) AS BIGINT)) AS DOUBLE) / count(*), 4) AS mean FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1 HAVING count(*) >= 2)
SELECT * FROM (SELECT *, 'top' AS side FROM b ORDER BY mean DESC, n_name LIMIT 5) UNION ALL SELECT * FROM (SELECT *, 'bottom' AS side FROM b ORDER BY mean, n_name LIMIT 5)""",
    "split_explode_report": "SELECT token, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size FROM (SELECT unnest(CASE WHEN p_size > 5 THEN string_split(p_name, ' ') ELSE ['(none)'] END) AS token, p_size FROM part) GROUP BY 1",
    "failure_ladder": f"SELECT {_LADDER_SQL} AS category, count(*) AS n FROM orders GROUP BY 1",
    "bottleneck_rank": f"WITH b AS (SELECT {_LADDER_SQL} AS category, count(*) AS n FROM orders GROUP BY 1), s AS (SELECT *, round(CAST(n AS DOUBLE) / sum(n) OVER (), 4) AS share FROM b) SELECT *, CAST(row_number() OVER (ORDER BY n DESC, category) AS INTEGER) AS rk FROM s WHERE category <> 'ok'",
    "state_counts_with_zeros": "SELECT state, count(o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('P'), ('X')) s(state) LEFT JOIN orders ON state = o_orderstatus GROUP BY 1",
    "identity_merge": """WITH d AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
a AS (SELECT o_custkey, CAST(max(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END) AS INTEGER) AS state, max(o_totalprice) AS confidence, min(o_orderdate) AS created FROM orders GROUP BY 1)
SELECT a.o_custkey, d.o_orderkey AS last_done, state, confidence, created FROM a LEFT JOIN d ON a.o_custkey = d.o_custkey""",
    "best_record_per_key": "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_totalprice DESC, o_orderkey) = 1",
    "examples_per_group": "SELECT p_type, p_partkey, p_name, CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS INTEGER) AS rk FROM part QUALIFY rk <= 5",
    "adjacent_runs": """WITH m AS (SELECT user_id, event_id, event_type, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM m) SELECT user_id, event_type, count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM r GROUP BY user_id, run, event_type""",
    "rolling_context": "SELECT conv_id, turn, count(*) OVER w AS in_window, CAST(sum(length(text)) OVER w AS BIGINT) AS window_chars FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)",
    "carry_forward_section": "SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM conversations",
    "invariants": """SELECT 'line_without_order' AS name, count(*) AS violations FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'null_field', count(*) FROM orders WHERE o_custkey IS NULL OR o_orderdate IS NULL
UNION ALL SELECT 'order_key_twice', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'value_out_of_range', count(*) FROM lineitem WHERE l_quantity <= 0 OR l_discount < 0 OR l_discount > 1""",
    "key_prefix_freq": "SELECT split_part(p_name, ' ', 1) AS prefix, count(*) AS n FROM part GROUP BY 1",
    "multi_key_review_sort": "SELECT CAST(row_number() OVER (ORDER BY (c_acctbal < 0) DESC, (c_nationkey < 5), c_nationkey, lower(c_name), c_custkey) AS INTEGER) AS rank, c_custkey, c_acctbal < 0 AS broke, c_nationkey < 5 AS near, c_nationkey FROM customer",
    "adaptive_cap": """WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey) AS n, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS INTEGER) AS rk FROM lineitem),
c AS (SELECT l_orderkey, l_partkey, l_suppkey, rk, CAST(CASE WHEN n >= 7 THEN 2 WHEN n >= 4 THEN 3 ELSE n END AS INTEGER) AS cap FROM r) SELECT * FROM c WHERE rk <= cap""",
    "bounded_bfs": f"{_BFS_SQL} SELECT * FROM found",
    "bfs_page_budget": f"{_BFS_SQL} SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY root ORDER BY depth, node) <= 150",
    "graph_branching": "WITH o AS (SELECT l_orderkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1) SELECT count(*) AS nodes, CAST(sum(n) AS BIGINT) AS edges, round(avg(n), 4) AS mean_out, max(n) AS max_out FROM o",
    "stream_window_counts": "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS value FROM events GROUP BY 1, 2",
}
