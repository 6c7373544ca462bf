"""Queries of the page operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import text
from tidewater.operators import matching, members, web
from tidewater.plans.tables import table

#: The pages hold invented words only, so the rules name words that occur.
SLOTS = [("articles", "the", "anchor"), ("articles", "the", "path"), ("people", "and", "anchor"), ("people", "and", "path"), ("contact", "die", "anchor"), ("contact", "que", "path")]
KINDS = [("group", r"\bthe\b", 0.5), ("lab", r"\b(and|of)\b", 0.4), ("home", r"\b(die|la|de)\b", 0.3)]
GUARDS = [(r"\bof\b", 0.2), (r"tion", 0.1)]


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def url_canonical_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", text.url_key(F.col("url")).alias("key"), text.host(F.col("url")).alias("host"))


def url_cache_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", text.digest_id(F.col("url")).alias("id"))


def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", text.title(F.col("html")).alias("title"))


def page_visible_text_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = F.length(text.visible(F.col("html")))
    return _pages(spark, sf_dir).select("page_id", seen.alias("visible"), F.round(seen.cast("double") / F.length("html"), 4).alias("ratio"))


def host_page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).groupBy(text.bare_host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


def denylist_first_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pages(spark, sf_dir).select((F.col("page_id") % 50).alias("grp"), "page_id", "url", text.host(F.col("url")).alias("host"))
    denied = rows.where(F.col("host").rlike("^(m|blog)[.]")).select("host").distinct()
    return matching.first_allowed(rows, denied, "grp", "host", "page_id", "url")


def email_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size(F.regexp_extract_all("text", F.lit("[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"), F.lit(0)))
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.sum(n).alias("emails"), F.count_if(n > 0).alias("documents"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.links(_pages(spark, sf_dir)).select("page_id", "pos", "anchor", "href", "url", "side")


def link_dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = web.links(_pages(spark, sf_dir))
    before = rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("links"), F.countDistinct("url", F.lower("anchor")).alias("kept"))
    return before.withColumn("dropped", F.col("links") - F.col("kept"))


def link_slot_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.slots(web.links(_pages(spark, sf_dir)), SLOTS)


def candidate_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.candidates(web.links(_pages(spark, sf_dir)), KINDS, GUARDS)


def nearby_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.nearby_pages(web.links(_pages(spark, sf_dir)), ["the", "and", "der"]).select("page_id", "rk", "by", "anchor", "url")


def lab_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.labs(web.links(_pages(spark, sf_dir)), ["the", "tion"]).select("page_id", "rk", "confidence", "anchor", "url")


def page_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = lambda w: rf"(^| ){w}( |$)"
    types = [("article", [(word("the"), 0.3), (word("and"), 0.2)]), ("listing", [(word("der"), 0.3), (word("die"), 0.2)]), ("profile", [(word("la"), 0.3), (word("de"), 0.2)])]
    kind, score = web.classified(text.visible(F.col("html")), F.col("url"), text.title(F.col("html")), types)
    return _pages(spark, sf_dir).select("page_id", kind.alias("kind"), score.alias("score"))


_LABELS = [
    ("Former PhD students", "phd_student", "current"), ("MASTER'S students", "master_student", "current"), ("Postdoctoral  fellows", "postdoc", "current"), ("Lab members", "unknown", "current"), ("Research staff", "research_staff", "current"),
    ("People:", "unknown", "current"), ("Students", "phd_student", "current"), ("Alumni :", "alumni", "alumni"), ("Visitors of the year", "visitor", "current"), ("Faculty", "professor", "current"), ("Past members", "alumni", "alumni"), ("Publications", None, None), ("alumni " + "x" * 350, None, None),
]


def section_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as labels of sections."""
    labels = F.array(*[F.lit(x) for x, _, _ in _LABELS])
    role, status = members.section_role(F.get(labels, (F.col("p_partkey") % len(_LABELS)).cast("int")))
    return table(spark, sf_dir, "part").groupBy(role.alias("role"), status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


#: Customers on one page.
_ON_PAGE = 40


def roster_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that list customers: students first, then alumni, as lists, tables, heading cards or definition lists."""
    k = F.col("c_custkey")
    page, former = F.floor(k / _ON_PAGE).cast("long"), k % _ON_PAGE >= 30
    code = F.translate(F.lpad(k.cast("string"), 7, "0"), "0123456789", "abcdefghij")
    name = F.concat(F.initcap(code), F.lit(" "), F.initcap(F.reverse(code)))
    said = F.when(former, "alumnus").otherwise("PhD student")
    part = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    item = (
        F.when(page % 4 == 0, part('<li><a href="/p/', k.cast("string"), '">', name, "</a>, ", said, "</li>")).when(page % 4 == 1, part("<tr><td>", name, "</td><td>", said, "</td></tr>"))
        .when(page % 4 == 2, part("<h3>", name, "</h3><p>", said, "</p>")).otherwise(part("<dt>", name, "</dt><dd>", said, "</dd>"))
    )
    rows = table(spark, sf_dir, "customer").select(page.alias("page_id"), F.struct(k.alias("k"), former.alias("former"), item.alias("item")).alias("e"))
    # A page has at most _ON_PAGE entries.
    each = rows.groupBy("page_id").agg(F.sort_array(F.collect_list("e")).alias("es"))
    tag = F.element_at(F.array(*map(F.lit, ("ul", "table", "div", "dl"))), (F.col("page_id") % 4 + 1).cast("int"))
    listed = lambda test: F.array_join(F.transform(F.filter("es", test), lambda e: e["item"]), "")
    html = part("<h2>PhD students</h2><", tag, ">", listed(lambda e: ~e["former"]), "</", tag, "><h2>Alumni</h2><", tag, ">", listed(lambda e: e["former"]), "</", tag, "><h2>Publications</h2><ul><li>Ann Lee, A paper</li></ul>")
    return each.select("page_id", F.lit("http://h.org/").alias("url"), html.alias("html"))


def page_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members.members(roster_pages(spark, sf_dir)).select("page_id", "pos", "name", "section", "status", "role", "url", "layout")


def person_validation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as entries: their keys decide what each shows."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", (k % 3).alias("name"), (k % 5 != 0).alias("in_section"), (k % 2 == 0).alias("section"), (k % 5 % 3).alias("role"), (k % 7 == 0).alias("own"), (k % 4 == 0).alias("url"), (k % 3 == 1).alias("email"), (k % 11 == 0).alias("rejected")
    )
    score = web.person_score(F.col("name"), F.col("in_section"), F.col("section"), F.col("role"), F.col("own"), F.col("url"), F.col("email"), F.col("rejected"))
    out = rows.withColumn("score", score)
    sure = web.extraction_confidence(F.col("score"), F.col("url"), F.col("role") == 2, F.col("role") == 1, F.col("name") > 0)
    return out.select("c_custkey", "score", sure.alias("extraction"), (F.col("score") >= 0.55).alias("kept"))


def identity_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    state, sure = web.identity_state(k % 13 == 0, k % 4 == 0, k % 3 == 0, k % 5 < 3, k % 7 == 0, k % 11 == 0, k % 2 == 1)
    return table(spark, sf_dir, "customer").groupBy(state.alias("state"), sure.alias("confidence")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (
    url_canonical_key, url_cache_id, page_title, page_visible_text_ratio, host_page_counts, denylist_first_allowed, email_extraction, page_links, link_dedup_counts, link_slot_classification, candidate_scoring, nearby_pages, lab_links, page_classes,
    section_labels, page_members, person_validation_scores, identity_states,
)}

_HOST = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1))"
_VISIBLE = "trim(regexp_replace(lower(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')), '[ \\t\\r\\n]+', ' ', 'g'))"
_TITLE = "trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '[ \\t\\r\\n]+', ' ', 'g'))"
SQL = {
    "url_canonical_key": f"""SELECT page_id, lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1)) || '://' || {_HOST} || regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)), '/+', '/', 'g'),
 '/(index|default|home)[.](html?|php|aspx?)$', '/'), '/$', '') || regexp_extract(url, '^[^?#]*([?][^#]*)', 1) AS key, {_HOST} AS host FROM pages""",
    "url_cache_id": "SELECT page_id, substr(sha256(url), 1, 16) AS id FROM pages",
    "page_title": f"SELECT page_id, {_TITLE} AS title FROM pages",
    "page_visible_text_ratio": f"SELECT page_id, CAST(length({_VISIBLE}) AS INTEGER) AS visible, round(CAST(length({_VISIBLE}) AS DOUBLE) / length(html), 4) AS ratio FROM pages",
    "host_page_counts": f"SELECT regexp_replace({_HOST}, '^www[.]', '') AS host, count(*) AS n FROM pages GROUP BY 1",
    "denylist_first_allowed": f"SELECT page_id % 50 AS grp, arg_min(url, page_id) AS url FROM pages WHERE NOT regexp_matches({_HOST}, '^(m|blog)[.]') GROUP BY 1",
    "email_extraction": "WITH e AS (SELECT lang, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}')) AS n FROM documents) SELECT lang, CAST(sum(n) AS BIGINT) AS emails, count(*) FILTER (WHERE n > 0) AS documents FROM e GROUP BY 1",
    "page_classes": f"""WITH w AS (SELECT page_id, regexp_replace(lower(concat_ws(' ', {_TITLE}, regexp_replace(url, '[-_/.?=&]', ' ', 'g'), {_VISIBLE})), '[ \\t\\r\\n]+', ' ', 'g') AS t FROM pages),
m AS (SELECT page_id, {", ".join(f"regexp_matches(t, '(^| ){x}( |$)') AS is_{x}" for x in ("the", "and", "der", "die", "la", "de"))} FROM w),
s AS (SELECT page_id, {", ".join(f"CASE WHEN is_{a} THEN CAST(0.3 AS DOUBLE) ELSE 0 END + CASE WHEN is_{b} THEN CAST(0.2 AS DOUBLE) ELSE 0 END AS {n}" for n, a, b in (("article", "the", "and"), ("listing", "der", "die"), ("profile", "la", "de")))} FROM m)
SELECT page_id, CASE WHEN greatest(article, listing, profile) < 0.4 THEN 'unknown' WHEN article = greatest(article, listing, profile) THEN 'article' WHEN listing = greatest(article, listing, profile) THEN 'listing' ELSE 'profile' END AS kind,
  round(greatest(article, listing, profile), 4) AS score FROM s""",
    "section_labels": "WITH l(i, role, status) AS (VALUES " + ", ".join(f"({i}, " + (f"'{r}', '{s}')" if r else "NULL, NULL)") for i, (_, r, s) in enumerate(_LABELS)) + f") SELECT role, status, count(*) AS n FROM part JOIN l ON p_partkey % {len(_LABELS)} = i GROUP BY 1, 2",
    "page_members": f"""WITH c AS (SELECT c_custkey AS k, c_custkey // {_ON_PAGE} AS page_id, c_custkey % {_ON_PAGE} >= 30 AS former, translate(lpad(CAST(c_custkey AS VARCHAR), 7, '0'), '0123456789', 'abcdefghij') AS code FROM customer)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INTEGER) AS pos, upper(code[1]) || code[2:] || ' ' || upper(reverse(code)[1]) || reverse(code)[2:] AS name, CASE WHEN former THEN 'Alumni' ELSE 'PhD students' END AS section,
  CASE WHEN former THEN 'former' ELSE 'current' END AS status, CASE WHEN page_id % 4 = 3 THEN NULL WHEN former THEN 'alumnus' ELSE 'phd student' END AS role, CASE WHEN page_id % 4 = 0 THEN 'http://h.org/p/' || k END AS url,
  CASE page_id % 4 WHEN 0 THEN 'list' WHEN 1 THEN 'table' WHEN 2 THEN 'heading' ELSE 'definition' END AS layout FROM c""",
    "person_validation_scores": """WITH r AS (SELECT c_custkey, c_custkey % 3 AS name, c_custkey % 5 <> 0 AS inside, c_custkey % 2 = 0 AS sec, c_custkey % 5 % 3 AS role, c_custkey % 7 = 0 AS own, c_custkey % 4 = 0 AS url, c_custkey % 3 = 1 AS email, c_custkey % 11 = 0 AS bad FROM customer),
s AS (SELECT *, CASE WHEN bad OR name = 0 OR NOT inside OR NOT (own OR email OR role > 0) THEN CAST(0 AS DOUBLE) ELSE round(CAST((CASE name WHEN 2 THEN 25 ELSE 10 END + 25 + CASE role WHEN 2 THEN 20 WHEN 1 THEN 10 ELSE 0 END
  + greatest(CASE WHEN own THEN 25 WHEN url THEN 8 ELSE 0 END, CASE WHEN email THEN 15 ELSE 0 END) + CASE WHEN sec THEN 5 ELSE 0 END) AS DOUBLE) / 100, 4) END AS score FROM r)
SELECT c_custkey, score, round(least(CAST(1 AS DOUBLE), CAST(0.6 AS DOUBLE) * score + CAST(CASE WHEN url THEN 20 ELSE 0 END + CASE role WHEN 2 THEN 15 WHEN 1 THEN 5 ELSE 0 END + CASE WHEN name > 0 THEN 5 ELSE 0 END AS DOUBLE) / 100), 4) AS extraction, score >= 0.55 AS kept FROM s""",
    "identity_states": """WITH k AS (SELECT c_custkey AS k FROM customer), s AS (SELECT CASE WHEN k % 13 = 0 THEN 100 WHEN k % 4 = 0 THEN 0 WHEN k % 3 = 0 AND k % 5 < 3 THEN 85 WHEN k % 7 = 0 OR k % 11 = 0 THEN 75 WHEN k % 2 = 1 THEN 55 ELSE 0 END AS c FROM k)
SELECT CASE WHEN c = 100 THEN 'VERIFIED' WHEN c >= 75 THEN 'RESOLVABLE' WHEN c = 55 THEN 'PARTIAL' ELSE 'INVALID' END AS state, CAST(c AS DOUBLE) / 100 AS confidence, count(*) AS n FROM s GROUP BY 1, 2""",
}
