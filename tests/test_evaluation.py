from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import evaluation as ev
from tidewater.operators import summaries as su

SCHEMA = "name string, homepage string, fetch_status string, navigation_success boolean, depth int, confidence double, current_members int, former_members int, raw_members int, pages int, errors array<string>, venues string"
OLD = [("a", "http://a", "ok", True, 2, 0.9, 3, 1, 6, 2, ["x: 1", "y"], "V; W"), ("b", None, "none", False, None, None, 0, 0, 0, 0, [], ""), ("c", "http://c", "timeout", False, None, None, 0, 0, 0, 0, ["x : 2"], "V"), ("d", "http://d", "ok", True, 1, 0.5, 0, 2, 2, 1, None, None), ("e", "http://e", "ok", True, 3, 0.7, 8, 0, 8, 3, [], "W")]


def test_reports(spark):
    runs = spark.createDataFrame(OLD, SCHEMA)
    by = {r["category"]: (r["n"], r["examples"], r["share"]) for r in ev.failures(runs).collect()}
    assert by == {"ok": (2, ["a", "e"], 0.4), "no_homepage": (1, ["b"], 0.2), "fetch_failed": (1, ["c"], 0.2), "only_former": (1, ["d"], 0.2)}
    m = ev.metrics(runs).first()
    assert (m["people"], m["with_homepage"], m["fetched"], m["navigated"], m["members"], m["current"], m["median_current"], m["dedup_rate"], m["mean_depth"]) == (5, 4, 3, 3, 14, 11, 0, 0.125, 2.0)
    assert {r["band"]: r["n"] for r in ev.member_bands(runs).collect()} == {"0": 3, "1-5": 1, "6-20": 1}
    assert {r["prefix"]: r["n"] for r in ev.error_prefixes(runs).collect()} == {"x": 2, "y": 1}
    assert {r["venues"]: r["people"] for r in ev.by_group(runs, "venues", ";").collect()} == {"V": 2, "W": 2, "(unknown)": 2}
    assert {r["band"]: r["n"] for r in ev.confidence_bands(runs.where("confidence is not null")).collect()} == {"high": 1, "good": 1, "fair": 1}


def test_runs_compared(spark):
    old = spark.createDataFrame(OLD, SCHEMA)
    new = old.withColumn("current_members", F.when(F.col("name") == "d", 4).when(F.col("name") == "e", 0).otherwise(F.col("current_members"))).where("name <> 'b'")
    assert [(r["name"], r["delta"], r["change"]) for r in ev.changes(old, new).collect()] == [("e", -8, "newly_lost"), ("d", 4, "newly_found")]
    assert {(r["before"], r["after"]): r["n"] for r in ev.transitions(old, new).collect()} == {("ok", "ok"): 1, ("ok", "no_members"): 1, ("no_homepage", "missing"): 1, ("fetch_failed", "fetch_failed"): 1, ("only_former", "ok"): 1}
    a = spark.createDataFrame([("p", "X"), ("p", "y"), ("q", "z")], "person string, member string")
    b = spark.createDataFrame([("p", "Y"), ("p", "x"), ("r", "z")], "person string, member string")
    assert {r["person"]: r["same"] for r in ev.same_members(a, b).collect()} == {"p": True, "q": False, "r": False}


def test_assembly_chain_and_provider(spark):
    people = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    homes = spark.createDataFrame([("a", "http://a", "ok"), ("c", "http://c", "dead")], "name string, homepage string, fetch_status string")
    members = spark.createDataFrame([("a", "y"), ("a", "x")], "name string, member string")
    got = {r["name"]: (r["status"], r["n"], r["members"]) for r in ev.assembled(people, homes, members).collect()}
    assert got == {"a": ("success", 2, ["x", "y"]), "b": ("skipped", 0, []), "c": ("failed", 0, [])}
    assert ev.chained(people, [lambda d: d.withColumn("x", F.lit(1)), lambda d: d.where("name <> 'a'")]).count() == 2

    def provider(text):
        if text == "b":
            raise RuntimeError
        return text.upper() if text == "a" else None

    assert sorted(r["said"] for r in ev.answered(people, provider, "name", "said", F.lit("stub")).collect()) == ["A", "stub", "stub"]


def test_texts(spark):
    row = spark.createDataFrame([("Ann Lee", "Here U", ["x", "y", "x"], ["V"], 7, "a long text that goes on", [("p", "http://p"), ("q", "http://q")])], "name string, uni string, areas array<string>, venues array<string>, n int, t string, links array<struct<anchor:string,url:string>>")
    f = lambda c: row.select(c).first()[0]
    assert f(su.shortened(F.col("t"), 8)) == "a long…" and f(su.preview(F.col("areas"), 2, "; ")) == "x; y; … 1 more" and f(su.padded(F.col("areas"), 3, "-")) == ["x", "y", "-"]
    assert f(su.summary(F.col("name"), F.col("uni"), F.array_distinct("areas"), F.col("venues"), F.col("n"))) == "Ann Lee at Here U works on x, y. They are an active author of 7 papers, mostly in V."
    assert f(su.page_prompt(F.col("name"), F.col("uni"), F.col("t"), F.col("links"), most=1)) == "Person: Ann Lee\nTitle: Here U\nText: a long text that goes on\nLinks:\n- p -> http://p"
    papers = spark.createDataFrame([("a", "T1", "V", 2000), ("a", "T2", "V", 2001), ("a", "T0", "W", 2001)], "person string, title string, venue string, year int")
    assert su.recent_titles(papers, size=2).first()["titles"] == ["T0 (W 2001)", "T2 (V 2001)"]
