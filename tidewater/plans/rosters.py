"""Queries of the roster and link-graph operators, the exports and the run comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import url_key
from tidewater.operators import bibliography as bib
from tidewater.operators import roster, web
from tidewater.plans.ranking import SCORES_SQL, scores
from tidewater.plans.tables import PAPERS_SQL, papers, table

ROLES = [("student", ("bolt", "rod")), ("faculty", ("gear", "ring")), ("staff", ("plate",))]
VENUES = [("First", ["brand#1", "b#1"]), ("Second", ["brand#2x", "d#2"]), ("Third", ["brand#3", "#4"])]


def _n() -> object:
    return F.count(F.lit(1)).alias("n")


def role_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(roster.role_of(F.col("p_name"), ROLES).alias("role")).agg(_n())


def page_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(roster.page_kind(F.col("url")).alias("kind")).agg(_n())


def followable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of pages, some turned into ones that are never followed or into the page itself."""
    k = F.col("page_id") % 6
    url = F.when(k == 0, F.concat(F.lit("mailto:"), "url")).when(k == 1, F.lit("https://www.x.com/a")).when(k == 2, F.lit("https://a.org/paper.PDF")).when(k == 3, F.concat("url", F.lit("#part"))).when(k == 4, F.lit("https://netflix.com/x")).otherwise(F.lit("https://a.org/new"))
    rows = table(spark, sf_dir, "pages").select("page_id", "url", url.alias("to"))
    return rows.select("page_id", roster.ignorable(F.col("to")).alias("ignored"), roster.plausible_move(F.col("to"), F.col("url")).alias("moved"))


def foreign_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_brand", roster.foreign_title(F.initcap("p_name"), F.col("p_type"), ("widget", "lab")).alias("foreign"))
    return rows.groupBy("p_brand").agg(F.count_if("foreign").alias("foreign"), _n())


def sources_in_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of three sources that overlap: each address once, from the first source that has it."""
    pages = table(spark, sf_dir, "pages").select("page_id", (F.col("page_id") % 10).alias("grp"), F.col("url"))
    out = roster.united([pages.where(f"page_id % {k} = 0").select("grp", "url") for k in (4, 3, 1)], ["grp"])
    return out.groupBy("grp", "src_ord").agg(_n())


def venue_by_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(_n()).select("p_brand", roster.alias_match(F.col("p_brand"), VENUES).alias("venue"), "n")


def alias_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the supplier of their number, which is known by two names."""
    known = table(spark, sf_dir, "supplier").select("s_suppkey", F.array("s_name", F.upper(F.regexp_replace("s_name", "Supplier", "Customer"))).alias("names"))
    return roster.alias_enriched(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), known, "c_name", "names", "s_suppkey")


def member_link_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of a nation and the links of its suppliers: by name for some, by address for others."""
    number = F.regexp_extract("s_name", "([0-9]+)$", 1)
    links = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("page"), F.concat(F.lit("CUSTOMER#"), number).alias("anchor"), F.concat(F.lit("http://H.org/"), number, F.lit("/")).alias("url"))
    profile = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("http://h.org//"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")))
    members = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("page"), "c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise("nobody").alias("name"), profile.alias("profile"))
    return roster.member_links(members, links, "page").where("link is not null").select("page", "c_custkey", "link")


def candidate_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), F.lit("PARTIAL").alias("state"))
    exported = rows.where("c_custkey % 3 = 0").select(F.upper("name").alias("name"))
    reasons = rows.where("c_custkey % 4 = 1").select("name", F.concat(F.lit("reason "), (F.col("c_custkey") % 5).cast("string")).alias("reason"))
    return roster.verified(rows, exported, reasons, "name").groupBy("state", "reason").agg(_n())


def self_rows_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_name", "n_regionkey").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select("n_name", F.when(F.col("n_regionkey") % 2 == 0, F.concat(F.lit(" "), F.lower("n_name"))).otherwise(F.col("r_name")).alias("target"))
    return roster.others_only(rows, "n_name", "target").select("n_name")


def navigation_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    way = roster.journey(F.col("url"), F.when(F.col("page_id") % 2 == 0, F.lower("url")), F.when(F.col("page_id") % 3 == 0, F.lit("http://end/")), F.lit("http://end/"))
    label = roster.edge_label(F.when(F.col("page_id") % 4 == 0, F.lit(" here ")), F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(way, " > ").alias("way"), label.alias("label"))


def type_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roster.frequencies(table(spark, sf_dir, "part"), F.col("p_type"), 15, "p_type")


def link_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order, by its status: count, mean to one place (half to even), least and most."""
    each = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("links"))
    return table(spark, sf_dir, "orders").join(each, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderstatus").agg(*roster.spread(F.col("links")))


def run_metric_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(test: str) -> DataFrame:
        rows = table(spark, sf_dir, "orders").where(test)
        return rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), F.countDistinct("o_custkey").alias("people"))

    return roster.metric_deltas(run("year(o_orderdate) = 1996"), run("year(o_orderdate) = 1997 and o_orderpriority <> '5-LOW'"), "o_orderpriority", ["orders", "people"])


def export_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven columns for each person: areas as one text of five at most, the new score or where there is none the old, and the priority."""
    areas = papers(spark, sf_dir, by="person").groupBy("person").agg(F.sort_array(F.collect_set(F.regexp_extract("title", "^[^ ]+", 0))).alias("all"), F.countDistinct("venue").alias("venues"))
    rows = scores(spark, sf_dir).join(areas, "person")
    score = F.coalesce(F.when(F.col("person") % 5 != 0, F.col("overall")), F.col("legacy"))
    return rows.select("person", "papers", "venues", F.array_join(F.slice("all", 1, 5), ", ").alias("areas"), score.alias("score"), bib.priority(score).alias("priority"), "affinity")


def export_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence labels: High from .85 with a homepage, Medium from .6, else Low."""
    c, home = F.bround(F.col("affinity") + F.col("venue_score") / 50, 3), F.col("person") % 3 == 0
    label = F.when((c >= 0.85) & home, "High").when(c >= 0.6, "Medium").otherwise("Low")
    return scores(spark, sf_dir).select("person", c.alias("confidence"), label.alias("label"))


def department_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as pages with their customers as entries; some have points of their address or title."""
    each = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.col("c_mktsegment") == "BUILDING").alias("faculty"), F.countDistinct(F.when(F.col("c_acctbal") > 0, F.col("c_name"))).alias("profiles"))
    k = F.col("c_nationkey")
    found, sure = web.department_scope(F.when(k % 2 == 0, 0.25).otherwise(0.0), F.when(k % 5 == 0, 0.3).otherwise(0.0), F.col("entries"), F.col("faculty"), F.col("profiles"), k % 3 == 0)
    return each.select("c_nationkey", found.alias("department"), sure.alias("confidence"))


def words_nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in which a digit stands within 120 characters of the first full stop."""
    rows = table(spark, sf_dir, "documents").where("text is not null").select("source", roster.surrounded(F.col("text"), ".", "[0-9]").alias("near"))
    return rows.groupBy("source").agg(F.count_if("near").alias("near"), _n())


def proceedings_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venues and years with their papers; ones of a single paper are skipped as empty."""
    return papers(spark, sf_dir).groupBy("venue", "year").agg(F.countDistinct("paper").alias("papers"), F.min("title").alias("first_title")).where("papers > 1")


def resolution_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by the kind of address: how many have a canonical key, and the rates (half to even)."""
    rows = table(spark, sf_dir, "pages").select(roster.page_kind(F.col("url")).alias("kind"), url_key(F.col("url")).alias("key"), F.col("url").rlike("[?]").alias("asks"))
    return rows.groupBy("kind").agg(_n(), F.count("key").alias("resolved"), F.bround(F.count_if("asks") / F.count(F.lit(1)), 4).alias("asking"))


QUERIES = {f.__name__: f for f in (
    role_labels, page_kinds, followable_pages, foreign_titles, sources_in_priority, venue_by_alias, alias_enrichment, member_link_resolution, candidate_verification, self_rows_excluded, navigation_paths, type_frequencies, link_spread,
    run_metric_deltas, export_short, export_labelled, department_pages, words_nearby, proceedings_groups, resolution_rates,
)}

_PATH = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_KIND = f"""CASE WHEN contains(lower({_PATH}), '~') OR regexp_matches(lower({_PATH}), '/(people|person|profile|user|users|home)/[^/]+/?$') THEN 'personal' WHEN regexp_matches(lower({_PATH}), '(^|[/_-])(lab|labs|group|groups|team)([/_-]|$)') THEN 'group'
  WHEN regexp_matches(lower({_PATH}), '(^|/)(faculty|staff)(/|$)') THEN 'faculty' WHEN regexp_matches(lower({_PATH}), '(^|/)(dept|department|departments|school)(/|$)') THEN 'department' ELSE 'unknown' END"""
_KEY = """lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1)) || '://' || lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)) || regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)), '/+', '/', 'g'),
 '/(index|default|home)[.](html?|php|aspx?)$', '/'), '/$', '') || regexp_extract(url, '^[^?#]*([?][^#]*)', 1)"""
SQL = {
    "role_labels": "SELECT CASE WHEN contains(p_name, 'bolt') OR contains(p_name, 'rod') THEN 'student' WHEN contains(p_name, 'gear') OR contains(p_name, 'ring') THEN 'faculty' WHEN contains(p_name, 'plate') THEN 'staff' ELSE 'unknown' END AS role, count(*) AS n FROM part GROUP BY 1",
    "page_kinds": f"SELECT {_KIND} AS kind, count(*) AS n FROM pages GROUP BY 1",
    "followable_pages": "SELECT page_id, page_id % 6 < 3 AS ignored, page_id % 6 >= 4 AS moved FROM pages",
    "foreign_titles": """WITH p AS (SELECT p_brand, p_name, string_split(p_name, ' ') AS w, list_filter(string_split(p_name, ' '), lambda x: length(x) > 2) AS a, list_filter(string_split(lower(p_type), ' '), lambda x: length(x) > 2) AS b FROM part)
SELECT p_brand, count(*) FILTER (WHERE length(p_name) <= 60 AND len(w) BETWEEN 2 AND 4 AND regexp_full_match(p_name, '[A-Za-z ]+') AND NOT contains(p_name, 'widget') AND NOT contains(p_name, 'lab') AND NOT list_has_any(a, b)) AS foreign, count(*) AS n FROM p GROUP BY 1""",
    "sources_in_priority": f"""WITH s AS (SELECT 0 AS src_ord, * FROM pages WHERE page_id % 4 = 0 UNION ALL SELECT 1, * FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT 2, * FROM pages),
k AS (SELECT page_id % 10 AS grp, src_ord FROM s QUALIFY row_number() OVER (PARTITION BY page_id % 10, {_KEY} ORDER BY src_ord, url) = 1) SELECT grp, CAST(src_ord AS INTEGER) AS src_ord, count(*) AS n FROM k GROUP BY 1, 2""",
    "venue_by_alias": """WITH b AS (SELECT p_brand, lower(p_brand) AS v, count(*) AS n FROM part GROUP BY 1, 2)
SELECT p_brand, CASE WHEN v IN ('first', 'brand#1', 'b#1') THEN 'First' WHEN v IN ('second', 'brand#2x', 'd#2') THEN 'Second' WHEN v IN ('third', 'brand#3', '#4') THEN 'Third'
  WHEN contains(v, 'brand#1') THEN 'First' WHEN contains('brand#2x', v) THEN 'Second' WHEN contains(v, 'brand#3') THEN 'Third' END AS venue, n FROM b""",
    "alias_enrichment": "SELECT c_custkey, c_name, s_suppkey FROM customer LEFT JOIN supplier ON lower(c_name) = replace(lower(s_name), 'supplier', 'customer')",
    "member_link_resolution": """WITH l AS (SELECT s_nationkey AS page, regexp_extract(s_name, '([0-9]+)$', 1) AS number FROM supplier),
m AS (SELECT c_nationkey AS page, c_custkey, CASE WHEN c_custkey % 3 = 0 THEN regexp_extract(c_name, '([0-9]+)$', 1) END AS a, CASE WHEN c_custkey % 2 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS b FROM customer)
SELECT m.page, c_custkey, 'http://H.org/' || coalesce(x.number, y.number) || '/' AS link FROM m LEFT JOIN l x ON m.page = x.page AND m.a = x.number LEFT JOIN l y ON m.page = y.page AND m.b = y.number WHERE coalesce(x.number, y.number) IS NOT NULL""",
    "candidate_verification": "SELECT CASE WHEN c_custkey % 3 = 0 THEN 'VERIFIED' ELSE 'PARTIAL' END AS state, CASE WHEN c_custkey % 4 = 1 THEN 'reason ' || (c_custkey % 5) END AS reason, count(*) AS n FROM customer GROUP BY 1, 2",
    "self_rows_excluded": "SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey % 2 = 1 AND lower(n_name) <> lower(r_name)",
    "navigation_paths": """SELECT page_id, url || CASE WHEN page_id % 2 = 0 AND lower(url) <> url THEN ' > ' || lower(url) ELSE '' END || ' > http://end/' AS way, CASE WHEN page_id % 4 = 0 THEN 'anchor:here' ELSE 'url:' || url END AS label FROM pages""",
    "type_frequencies": "SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 15",
    "link_spread": "WITH e AS (SELECT l_orderkey, count(*) AS links FROM lineitem GROUP BY 1) SELECT o_orderstatus, count(*) AS count, round_even(avg(links), 1) AS mean, min(links) AS least, max(links) AS most FROM orders JOIN e ON o_orderkey = l_orderkey GROUP BY 1",
    "run_metric_deltas": """WITH a AS (SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS people FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1), b AS (SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS people FROM orders WHERE year(o_orderdate) = 1997 AND o_orderpriority <> '5-LOW' GROUP BY 1),
x AS (SELECT o_orderpriority, 'orders' AS metric, orders AS v FROM a UNION ALL SELECT o_orderpriority, 'people', people FROM a), y AS (SELECT o_orderpriority, 'orders' AS metric, orders AS v FROM b UNION ALL SELECT o_orderpriority, 'people', people FROM b),
z AS (SELECT o_orderpriority, metric, coalesce(x.v, 0) AS old, coalesce(y.v, 0) AS new FROM x FULL JOIN y USING (o_orderpriority, metric)) SELECT *, CASE WHEN new >= old THEN '+' ELSE '-' END || abs(new - old) AS delta FROM z""",
    "export_short": f"""WITH {SCORES_SQL}, a AS (SELECT person, list_sort(list(DISTINCT string_split(title, ' ')[1])) AS every, count(DISTINCT venue) AS venues FROM papers GROUP BY 1),
e AS (SELECT person, papers, venues, array_to_string(every[1:5], ', ') AS areas, CASE WHEN person % 5 <> 0 THEN overall ELSE legacy END AS score, affinity FROM scores JOIN a USING (person))
SELECT person, papers, venues, areas, score, CASE WHEN score >= 80 THEN 'P0' WHEN score >= 60 THEN 'P1' WHEN score >= 40 THEN 'P2' ELSE 'P3' END AS priority, affinity FROM e""",
    "export_labelled": f"WITH {SCORES_SQL}, c AS (SELECT person, round_even(affinity + venue_score / 50, 3) AS confidence FROM scores) SELECT person, confidence, CASE WHEN confidence >= 0.85 AND person % 3 = 0 THEN 'High' WHEN confidence >= 0.6 THEN 'Medium' ELSE 'Low' END AS label FROM c",
    "department_pages": """WITH e AS (SELECT c_nationkey, count(*) AS entries, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS faculty, count(DISTINCT CASE WHEN c_acctbal > 0 THEN c_name END) AS profiles FROM customer GROUP BY 1),
p AS (SELECT *, CASE WHEN c_nationkey % 2 = 0 THEN 25 ELSE 0 END AS u, CASE WHEN c_nationkey % 5 = 0 THEN 30 ELSE 0 END AS t, CASE WHEN entries > 100 THEN 35 WHEN entries > 50 THEN 20 WHEN entries > 30 THEN 10 ELSE 0 END
  + CASE WHEN faculty >= 20 THEN 30 WHEN faculty >= 10 THEN 20 WHEN faculty >= 5 THEN 10 ELSE 0 END + CASE WHEN profiles >= 30 THEN 15 WHEN profiles >= 15 THEN 10 ELSE 0 END AS rest FROM e),
s AS (SELECT *, round(least(CAST(1 AS DOUBLE), CAST(u + t + rest AS DOUBLE) / CASE WHEN entries <= 25 AND faculty <= 2 AND c_nationkey % 3 = 0 THEN 200 ELSE 100 END), 3) AS confidence FROM p)
SELECT c_nationkey, confidence >= 0.55 AND (u + t > 0 OR confidence >= 0.75) AS department, confidence FROM s""",
    "words_nearby": """WITH d AS (SELECT source, text, instr(text, '.') AS place FROM documents WHERE text IS NOT NULL), w AS (SELECT source, place > 0 AND regexp_matches(substr(text, CAST(greatest(place - 120, 1) AS BIGINT), CAST(place + 1 + 120 - greatest(place - 120, 1) AS BIGINT)), '[0-9]') AS near FROM d)
SELECT source, count(*) FILTER (WHERE near) AS near, count(*) AS n FROM w GROUP BY 1""",
    "proceedings_groups": f"WITH {PAPERS_SQL} SELECT venue, year, count(DISTINCT paper) AS papers, min(title) AS first_title FROM papers GROUP BY 1, 2 HAVING count(DISTINCT paper) > 1",
    "resolution_rates": f"SELECT {_KIND} AS kind, count(*) AS n, count(*) FILTER (WHERE regexp_matches(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#:]+')) AS resolved, round_even(CAST(count(*) FILTER (WHERE contains(url, '?')) AS DOUBLE) / count(*), 4) AS asking FROM pages GROUP BY 1",
}
