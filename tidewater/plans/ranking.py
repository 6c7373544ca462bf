"""Queries of the bibliographic operators."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions.text import banded
from tidewater.operators import bibliography as bib
from tidewater.operators import matching, sequences
from tidewater.storage import checkpointed
from tidewater.plans.tables import ALIASES, FAVOURED, FAVOURED_SQL, PAPERS_SQL, TAXONOMY, TAXONOMY_SQL, WEIGHTS_SQL, papers, table, taxonomy, weights

PAPERS_CAP = 60.0


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each person with all parts of both scores."""
    rows = papers(spark, sf_dir).join(F.broadcast(weights(spark)), "venue", "left")
    # In one aggregate, whose state is a few numbers for each person: of each category whether a title has one of its terms.
    found = {f"_{c}": F.max(reduce(or_, [F.col("title").contains(t) for k, t in TAXONOMY if k == c])) for c in dict(TAXONOMY)}
    each = rows.groupBy("person").agg(
        F.count(F.lit(1)).alias("papers"), F.sum(F.coalesce("weight", F.lit(1.0))).alias("raw"), F.count_if(F.col("venue").isin(*FAVOURED)).alias("hits"), *(x.alias(name) for name, x in found.items())
    )
    # As in SQL, where areas are joined by person, no person has none.
    areas = reduce(add, [F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long")) for name in found])
    out = each.withColumn("areas", F.when(F.col("person").isNotNull(), areas).otherwise(F.lit(0).cast("long")))
    score, old = F.least(F.col("raw") / 4, F.lit(25.0)), F.least(F.col("raw") / 4, F.lit(30.0))
    share = F.col("hits").cast("double") / F.col("papers")
    return out.select(
        "person", "papers", score.alias("venue_score"), "areas", F.round(share, 4).alias("affinity"),
        F.round(bib.overall(F.col("papers"), score, F.col("areas"), share, PAPERS_CAP), 4).alias("overall"), F.round(bib.legacy(F.col("papers"), old, F.col("areas"), PAPERS_CAP), 4).alias("legacy"),
    )


SCORES_SQL = f"""{PAPERS_SQL}, {WEIGHTS_SQL}, {TAXONOMY_SQL},
areas AS (SELECT person, count(DISTINCT category) AS areas FROM (SELECT DISTINCT person, title FROM papers) JOIN taxonomy ON contains(title, term) GROUP BY 1),
each AS (
  SELECT person, count(*) AS papers, sum(coalesce(weight, CAST(1 AS DOUBLE))) AS raw, count(*) FILTER (WHERE venue IN ({FAVOURED_SQL})) AS hits
  FROM papers LEFT JOIN weights USING (venue) GROUP BY 1),
scores AS (
  SELECT person, papers, least(raw / 4, CAST(25 AS DOUBLE)) AS venue_score, coalesce(areas, 0) AS areas, round(CAST(hits AS DOUBLE) / papers, 4) AS affinity,
    round(CAST(30 AS DOUBLE) * least(CAST(papers AS DOUBLE), 60) / 60 + least(raw / 4, CAST(25 AS DOUBLE)) + CAST(15 AS DOUBLE) * least(CAST(coalesce(areas, 0) AS DOUBLE), 5) / 5
      + CAST(30 AS DOUBLE) * (CAST(hits AS DOUBLE) / papers), 4) AS overall,
    round(CAST(40 AS DOUBLE) * least(CAST(papers AS DOUBLE), 60) / 60 + least(raw / 4, CAST(30 AS DOUBLE)) + CAST(30 AS DOUBLE) * least(CAST(coalesce(areas, 0) AS DOUBLE), 5) / 5, 4) AS legacy
  FROM each LEFT JOIN areas USING (person))"""


def flagship_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = bib.ranked(scores(spark, sf_dir), [F.desc("overall"), F.asc("person")], 100)
    return top.select("rank", "person", "papers", "venue_score", "areas", "affinity", "overall", bib.priority(F.col("overall")).alias("priority"))


FLAGSHIP_SQL = f"""WITH {SCORES_SQL}
SELECT CAST(row_number() OVER (ORDER BY overall DESC, person) AS INTEGER) AS rank, person, papers, venue_score, areas, affinity, overall,
  CASE WHEN overall >= 80 THEN 'P0' WHEN overall >= 60 THEN 'P1' WHEN overall >= 40 THEN 'P2' ELSE 'P3' END AS priority
FROM scores ORDER BY overall DESC, person LIMIT 100"""


def venue_alias_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.rewritten(table(spark, sf_dir, "part").select(F.col("p_brand").alias("venue")), "venue", ALIASES).groupBy("venue").agg(F.count(F.lit(1)).alias("n"))


def venue_year_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = spark.createDataFrame([("Brand#1", 1996), ("Brand#1", 1997), ("Brand#12", 1998)], "venue string, year int")
    return papers(spark, sf_dir).join(F.broadcast(wanted), ["venue", "year"], "left_semi").select("person", "paper", "venue", "year")


def person_paper_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bib.counts(papers(spark, sf_dir, by="person"))


def paper_dedup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    order = [F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_suppkey"), F.desc("l_extendedprice")]
    return matching.best_record(lines, ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def venue_histogram_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bib.venue_histogram(papers(spark, sf_dir, by="person"), top=3)


def activity_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bib.activity(papers(spark, sf_dir))


def yearly_histogram_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).groupBy("person", "year").agg(F.count(F.lit(1)).alias("n"))


def distinct_venue_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir, by="person").groupBy("person").agg((F.least(F.countDistinct("venue"), F.lit(10).cast("long")) * 3).alias("score"))


def keyword_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title"))
    return bib.keyword_evidence(parts, taxonomy(spark)).select("p_partkey", "category", "term", "weight")


def venue_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = spark.createDataFrame([("first", "BRAND#1"), ("second", "brand#2"), ("first", "Brand#3")], "category string, venue_term string")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("venue"))
    return bib.venue_evidence(parts, terms).select("p_partkey", "category", "weight")


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("venue"), F.col("p_name").alias("title"))
    return bib.profile(bib.keyword_evidence(parts, taxonomy(spark)), "venue")


def topic_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _topics(spark, sf_dir).select("venue", "category", "score", "share")


def topic_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _topics(spark, sf_dir).where("rk <= 5").select("venue", "category", "rk")


TOPICS_SQL = f"""{TAXONOMY_SQL},
topics AS (SELECT p_brand AS venue, category, CAST(count(*) * 3 AS DOUBLE) AS score FROM part JOIN taxonomy ON contains(lower(p_name), term) GROUP BY 1, 2)"""


def keyword_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("venue"), F.col("p_name").alias("title"))
    return bib.keyword_evidence(parts, taxonomy(spark)).select("venue", "term").distinct()


def weighted_venue_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bib.weighted_venues(papers(spark, sf_dir), weights(spark), caps={"capped_25": 25.0, "capped_30": 30.0})


def affinity_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bib.affinity(papers(spark, sf_dir), FAVOURED)


def favoured_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir, by="person").where(F.col("venue").isin(*FAVOURED))
    return bib.venue_histogram(rows, top=3)


def legacy_vs_new_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = checkpointed(scores(spark, sf_dir).select("person", "overall", "legacy"))
    # Both rankings number every person: by range, so that no single task sorts all of them.
    new, old = both.groupBy("overall").agg(F.count(F.lit(1)).alias("n")), both.groupBy("legacy").agg(F.count(F.lit(1)).alias("n"))
    place = lambda d, c: d.select(c, (F.sum("n").over(Window.orderBy(F.desc(c)).rowsBetween(Window.unboundedPreceding, -1))).alias("ahead"))
    a = both.join(place(new, "overall").withColumnRenamed("ahead", "ahead_new"), "overall").join(place(old, "legacy").withColumnRenamed("ahead", "ahead_old"), "legacy")
    within = lambda c: F.row_number().over(Window.partitionBy(c).orderBy("person"))
    out = a.withColumns({"new_rank": F.coalesce("ahead_new", F.lit(0)) + within("overall"), "old_rank": F.coalesce("ahead_old", F.lit(0)) + within("legacy")})
    return out.select("person", "overall", "legacy", "new_rank", "old_rank", (F.col("old_rank") - F.col("new_rank")).alias("delta"))


def priority_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, sf_dir).groupBy(bib.priority(F.col("overall")).alias("priority")).agg(F.count(F.lit(1)).alias("n"))


_GAZETTEER = [("NATION_1", ["N1", "First Nation"], "AMERICA", 1), ("NATION_2", ["N2"], "ASIA", 2), ("NATION_10", ["Tenth, Old"], "AFRICA", 3)]


def affiliation_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), "n_name")
    raw = F.when(F.col("key") % 4 == 0, F.concat(F.lit("Dept. of Parts, "), "n_name")).when(F.col("key") % 4 == 1, F.concat(F.lit("N"), F.col("key").cast("string"), F.lit(", East"))).when(F.col("key") % 4 == 2, F.concat(F.lit("Institute "), "n_name", F.lit(" West"))).otherwise(F.col("n_name"))
    gazetteer = spark.createDataFrame(_GAZETTEER, "canonical string, aliases array<string>, country string, ord int")
    return matching.gazetteer_match(nation.select("key", raw.alias("raw")), gazetteer, "key", "raw")


def affiliation_unmatched_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    known = spark.createDataFrame([(f"NATION_{i}",) for i in range(0, 20)], "n_name string")
    missed = nation.join(known, "n_name", "left_anti")
    return table(spark, sf_dir, "customer").join(missed, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))


def region_filter_top100(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region").where("r_name = 'AMERICA'"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name")
    rows = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return bib.ranked(rows, [F.desc("c_acctbal"), F.asc("c_custkey")], 100).select("rank", "c_custkey", "c_name", "n_name", "c_acctbal")


def name_enrichment_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), F.when(F.col("c_acctbal") >= 5000, F.col("c_acctbal")).alias("balance"))
    extra = table(spark, sf_dir, "supplier").select(F.regexp_extract("s_name", "#([0-9]+)$", 1).alias("_key"), F.col("s_acctbal").alias("_balance"))
    return matching.enriched(people, extra, F.regexp_extract("name", "#([0-9]+)$", 1), {"balance": F.col("_balance")}).drop("_balance").select("c_custkey", "name", "balance", "matched")


def target_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    return table(spark, sf_dir, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


def _year_counts(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.year("o_orderdate") == year).groupBy(F.col("o_custkey").alias("person")).agg(F.count(F.lit(1)).alias("n"))


_YEARS_SQL = """old AS (SELECT o_custkey AS person, count(*) AS n FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1),
new AS (SELECT o_custkey AS person, count(*) AS n FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1),
both_runs AS (SELECT coalesce(old.person, new.person) AS person, old.n AS o, new.n AS w, coalesce(new.n, 0) - coalesce(old.n, 0) AS delta FROM old FULL JOIN new ON old.person = new.person),
compared AS (SELECT *, CASE WHEN o IS NULL THEN 'added' WHEN w IS NULL THEN 'removed' WHEN delta > 0 THEN 'improved' WHEN delta < 0 THEN 'regressed' ELSE 'unchanged' END AS status FROM both_runs)"""


def cohort_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = matching.compared(_year_counts(spark, sf_dir, 1996), _year_counts(spark, sf_dir, 1997), "person", "n")
    side = F.when(F.col("status") == "added", "right_only").when(F.col("status") == "removed", "left_only").otherwise("inner")
    return out.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


def cohort_delta_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.compared(_year_counts(spark, sf_dir, 1996), _year_counts(spark, sf_dir, 1997), "person", "n").select("person", F.col("old").alias("n_old"), F.col("new").alias("n_new"), "delta", "status")


def cohort_top_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = matching.compared(_year_counts(spark, sf_dir, 1996), _year_counts(spark, sf_dir, 1997), "person", "n")
    return out.orderBy(F.desc(F.abs("delta")), "person").limit(20).select("person", "delta", "status")


def top100_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = checkpointed(scores(spark, sf_dir).select("person", "overall", "legacy"))
    new = bib.ranked(both, [F.desc("overall"), F.asc("person")], 100).select("person", F.col("rank").alias("new_rank"))
    old = bib.ranked(both, [F.desc("legacy"), F.asc("person")], 100).select("person", F.col("rank").alias("old_rank"))
    out = old.join(new, "person", "full_outer")
    status = F.when(F.col("old_rank").isNull(), "added").when(F.col("new_rank").isNull(), "removed").otherwise("overlap")
    return out.select("person", "old_rank", "new_rank", (F.col("old_rank") - F.col("new_rank")).alias("delta"), status.alias("status"))


def transition_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = lambda n: banded(F.coalesce(n, F.lit(0)), [("none", 0), ("few", 2)], "many")
    out = matching.compared(_year_counts(spark, sf_dir, 1996), _year_counts(spark, sf_dir, 1997), "person", "n")
    return out.groupBy(label(F.col("old")).alias("before"), label(F.col("new")).alias("after")).agg(F.count(F.lit(1)).alias("n"))


def token_subset_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_name", "p_type").distinct()
    rows = names.select(F.col("p_name").alias("key"), "p_name").unionByName(names.select(F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("key"), F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("p_name"))).distinct()
    return matching.subset_pairs(rows, "key", "p_name").select("key_a", "key_b")


def greedy_name_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_brand", "p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" "), F.lower("p_type"))).alias("name"))
    return matching.greedy_merge(parts, "p_brand", "name", "p_partkey").select("p_brand", "leader", "n")


def recent_n_per_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return sequences.top_per_group(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 8)


QUERIES = {f.__name__: f for f in (
    flagship_ranking, venue_alias_rewrite, venue_year_selection, person_paper_counts, paper_dedup_last_wins, venue_histogram_long, activity_span, yearly_histogram_long, distinct_venue_score, keyword_evidence, venue_evidence, topic_profile,
    topic_top5, keyword_set, weighted_venue_score, affinity_share, favoured_top3, legacy_vs_new_scores, priority_bands, affiliation_tiers, affiliation_unmatched_freq, region_filter_top100, name_enrichment_left_join, target_semi_join,
    cohort_alignment, cohort_delta_status, cohort_top_changes, top100_overlap, transition_matrix, token_subset_pairs, greedy_name_merge, recent_n_per_person,
)}

_BAND = "CASE WHEN coalesce({0}, 0) <= 0 THEN 'none' WHEN coalesce({0}, 0) <= 2 THEN 'few' ELSE 'many' END"
SQL = {
    "flagship_ranking": FLAGSHIP_SQL,
    "venue_alias_rewrite": "SELECT CASE WHEN p_brand IN ('Brand#21','Brand#22','Brand#23','Brand#24','Brand#25') THEN 'Brand#' || (CAST(substr(p_brand, 7) AS INTEGER) - 20) ELSE p_brand END AS venue, count(*) AS n FROM part GROUP BY 1",
    "venue_year_selection": f"WITH {PAPERS_SQL} SELECT person, paper, venue, year FROM papers WHERE (venue = 'Brand#1' AND year IN (1996, 1997)) OR (venue = 'Brand#12' AND year = 1998)",
    "person_paper_counts": f"WITH {PAPERS_SQL} SELECT person, count(*) AS papers, count(DISTINCT venue) AS venues, count(DISTINCT year) AS years FROM papers GROUP BY 1",
    "paper_dedup_last_wins": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1",
    "venue_histogram_long": f"WITH {PAPERS_SQL}, h AS (SELECT person, venue, count(*) AS n FROM papers GROUP BY 1, 2) SELECT *, CAST(row_number() OVER (PARTITION BY person ORDER BY n DESC, venue) AS INTEGER) AS rk FROM h QUALIFY rk <= 3",
    "activity_span": f"WITH {PAPERS_SQL}, s AS (SELECT person, min(year) AS first_year, max(year) AS last_year, CAST(max(year) - min(year) + 1 AS INTEGER) AS span, count(*) AS papers FROM papers GROUP BY 1) SELECT *, round(least(CAST(papers AS DOUBLE) / span, CAST(5 AS DOUBLE)) * 4, 4) AS productivity FROM s",
    "yearly_histogram_long": f"WITH {PAPERS_SQL} SELECT person, year, count(*) AS n FROM papers GROUP BY 1, 2",
    "distinct_venue_score": f"WITH {PAPERS_SQL} SELECT person, least(count(DISTINCT venue), 10) * 3 AS score FROM papers GROUP BY 1",
    "keyword_evidence": f"WITH {TAXONOMY_SQL} SELECT p_partkey, category, term, CAST(3 AS DOUBLE) AS weight FROM part JOIN taxonomy ON contains(lower(p_name), term)",
    "venue_evidence": "WITH t(category, term) AS (VALUES ('first', 'BRAND#1'), ('second', 'brand#2'), ('first', 'Brand#3')) SELECT p_partkey, category, CAST(2 AS DOUBLE) AS weight FROM part JOIN t ON upper(p_brand) = upper(term)",
    "topic_profile": f"WITH {TOPICS_SQL} SELECT venue, category, score, round(score / max(score) OVER (PARTITION BY venue), 4) AS share FROM topics",
    "topic_top5": f"WITH {TOPICS_SQL} SELECT venue, category, CAST(row_number() OVER (PARTITION BY venue ORDER BY score DESC, category) AS INTEGER) AS rk FROM topics QUALIFY rk <= 5",
    "keyword_set": f"WITH {TAXONOMY_SQL} SELECT DISTINCT p_brand AS venue, term FROM part JOIN taxonomy ON contains(lower(p_name), term)",
    "weighted_venue_score": f"WITH {PAPERS_SQL}, {WEIGHTS_SQL}, s AS (SELECT person, sum(coalesce(weight, CAST(1 AS DOUBLE))) AS raw FROM papers LEFT JOIN weights USING (venue) GROUP BY 1) SELECT person, raw, least(raw, CAST(25 AS DOUBLE)) AS capped_25, least(raw, CAST(30 AS DOUBLE)) AS capped_30 FROM s",
    "affinity_share": f"WITH {PAPERS_SQL} SELECT person, count(*) FILTER (WHERE venue IN ({FAVOURED_SQL})) AS hits, count(*) AS papers, round(CAST(count(*) FILTER (WHERE venue IN ({FAVOURED_SQL})) AS DOUBLE) / count(*), 4) AS affinity FROM papers GROUP BY 1",
    "favoured_top3": f"WITH {PAPERS_SQL}, h AS (SELECT person, venue, count(*) AS n FROM papers WHERE venue IN ({FAVOURED_SQL}) GROUP BY 1, 2) SELECT *, CAST(row_number() OVER (PARTITION BY person ORDER BY n DESC, venue) AS INTEGER) AS rk FROM h QUALIFY rk <= 3",
    "legacy_vs_new_scores": f"WITH {SCORES_SQL}, r AS (SELECT person, overall, legacy, row_number() OVER (ORDER BY overall DESC, person) AS new_rank, row_number() OVER (ORDER BY legacy DESC, person) AS old_rank FROM scores) SELECT *, old_rank - new_rank AS delta FROM r",
    "priority_bands": f"WITH {SCORES_SQL} SELECT CASE WHEN overall >= 80 THEN 'P0' WHEN overall >= 60 THEN 'P1' WHEN overall >= 40 THEN 'P2' ELSE 'P3' END AS priority, count(*) AS n FROM scores GROUP BY 1",
    "affiliation_tiers": """WITH r AS (SELECT n_nationkey AS key, CASE n_nationkey % 4 WHEN 0 THEN 'Dept. of Parts, ' || n_name WHEN 1 THEN 'N' || n_nationkey || ', East' WHEN 2 THEN 'Institute ' || n_name || ' West' ELSE n_name END AS raw FROM nation),
g(canonical, country, ord, name, alias) AS (VALUES ('NATION_1', 'AMERICA', 1, 'nation_1', 0), ('NATION_1', 'AMERICA', 1, 'n1', 1), ('NATION_1', 'AMERICA', 1, 'first nation', 1), ('NATION_2', 'ASIA', 2, 'nation_2', 0), ('NATION_2', 'ASIA', 2, 'n2', 1), ('NATION_10', 'AFRICA', 3, 'nation_10', 0), ('NATION_10', 'AFRICA', 3, 'tenth old', 1)),
norm AS (SELECT key, raw, replace(replace(lower(raw), '.', ''), ',', '') AS whole, [trim(replace(x, '.', '')) FOR x IN string_split(lower(raw), ',')] AS parts FROM r),
segs AS (SELECT key, unnest(list_prepend(whole, parts)) AS seg, generate_subscripts(list_prepend(whole, parts), 1) AS pos FROM norm),
hits AS (SELECT key, canonical, country, alias AS tier, pos, ord, CASE WHEN alias = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0.85 AS DOUBLE) END AS confidence FROM segs JOIN g ON seg = name
  UNION ALL SELECT key, canonical, country, alias + 2, 0, ord, CAST(0.6 AS DOUBLE) FROM norm JOIN g ON length(name) >= 5 AND contains(whole, name)),
won AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY key ORDER BY tier, pos, ord) = 1)
SELECT r.key, r.raw, canonical, country, coalesce(confidence, CAST(0 AS DOUBLE)) AS confidence FROM r LEFT JOIN won ON r.key = won.key""",
    "affiliation_unmatched_freq": "SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey >= 20 GROUP BY 1",
    "region_filter_top100": "SELECT CAST(row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS rank, c_custkey, c_name, n_name, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AMERICA' ORDER BY c_acctbal DESC, c_custkey LIMIT 100",
    "name_enrichment_left_join": "SELECT c_custkey, c_name AS name, coalesce(CASE WHEN c_acctbal >= 5000 THEN c_acctbal END, s_acctbal) AS balance, s_name IS NOT NULL AS matched FROM customer LEFT JOIN supplier ON substr(c_name, 10) = substr(s_name, 10)",
    "target_semi_join": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "cohort_alignment": f"WITH {_YEARS_SQL} SELECT CASE status WHEN 'added' THEN 'right_only' WHEN 'removed' THEN 'left_only' ELSE 'inner' END AS side, count(*) AS n FROM compared GROUP BY 1",
    "cohort_delta_status": f"WITH {_YEARS_SQL} SELECT person, o AS n_old, w AS n_new, delta, status FROM compared",
    "cohort_top_changes": f"WITH {_YEARS_SQL} SELECT person, delta, status FROM compared ORDER BY abs(delta) DESC, person LIMIT 20",
    "top100_overlap": f"""WITH {SCORES_SQL}, n AS (SELECT person, CAST(row_number() OVER (ORDER BY overall DESC, person) AS INTEGER) AS new_rank FROM scores QUALIFY new_rank <= 100),
o AS (SELECT person, CAST(row_number() OVER (ORDER BY legacy DESC, person) AS INTEGER) AS old_rank FROM scores QUALIFY old_rank <= 100)
SELECT person, old_rank, new_rank, old_rank - new_rank AS delta, CASE WHEN old_rank IS NULL THEN 'added' WHEN new_rank IS NULL THEN 'removed' ELSE 'overlap' END AS status FROM o FULL JOIN n USING (person)""",
    "transition_matrix": f"WITH {_YEARS_SQL} SELECT {_BAND.format('o')} AS before, {_BAND.format('w')} AS after, count(*) AS n FROM compared GROUP BY 1, 2",
    "token_subset_pairs": """WITH names AS (SELECT p_name AS k FROM part UNION SELECT p_name || ' ' || lower(p_type) FROM part), t AS (SELECT k, list_distinct(string_split(k, ' ')) AS w FROM names)
SELECT a.k AS key_a, b.k AS key_b FROM t a JOIN t b ON a.k <> b.k AND len(a.w) >= 2 AND len(b.w) >= 2 AND list_has_all(b.w, a.w)""",
    "recent_n_per_person": "SELECT o_custkey, o_orderkey, o_orderdate, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS rk FROM orders QUALIFY rk <= 8",
}
