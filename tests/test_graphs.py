from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import roster
from tidewater.sources import graphs


def test_graphs_from_json_have_defaults(spark):
    texts = ['{"url": "u", "nodes": [{"url": "a"}, {"url": "b", "confidence": 0.5, "node_type": "lab", "anchor": "x"}]}', "{}", "no json", None]
    rows = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(graphs.graph_of(F.col("t"))).collect()]
    assert [tuple(n) for n in rows[0]["nodes"]] == [("a", "", "unknown", 0.0), ("b", "x", "lab", 0.5)] and rows[0]["status"] == "unknown"
    assert rows[1]["nodes"] == [] and rows[1]["title"] == "" and rows[2] is None and rows[3] is None


def test_graphs_begin_with_the_page_and_are_written_by_type(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u1", "ok"), (2, "u2", "timeout"), (3, "u3", "ok")], "id int, url string, status string")
    links = spark.createDataFrame([(1, 1, "b", "x", "lab", 0.4), (1, 0, "a", "y", "people", 0.9), (2, 0, "c", "z", "lab", 0.2)], "id int, pos int, url string, anchor string, node_type string, confidence double")
    out = graphs.graphs(pages, links, "id")
    assert {r["id"]: [(n["url"], n["node_type"]) for n in r["nodes"]] for r in out.collect()} == {1: [("u1", "homepage"), ("a", "people"), ("b", "lab")], 2: [("u2", "failure")], 3: [("u3", "homepage")]}
    graphs.write_graphs(out, str(tmp_path), "id")
    assert {r["node_type"]: r["n"] for r in spark.read.json(f"{tmp_path}/summary").collect()} == {"homepage": 2, "failure": 1, "people": 1, "lab": 1}
    assert spark.read.parquet(f"{tmp_path}/nodes").count() == 5


def test_logs_candidates_and_reports(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "RESOLVABLE", 0.5), (1, "b", "VERIFIED", 0.9), (2, "c", "PARTIAL", 0.1)], "k int, name string, state string, c double")
    for run in ("one", "two", "one"):
        graphs.log_decisions(rows, f"{tmp_path}/log", run)
    assert {r["run"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/log").groupBy("run").count().collect()} == {"one": 3, "two": 3}
    assert {r["state"]: r["n"] for r in graphs.write_candidates(rows, f"{tmp_path}/c", ["k"], [F.desc("c")]).collect()} == {"VERIFIED": 1, "PARTIAL": 1}
    took = graphs.reported(rows, f"{tmp_path}/t", {"sure": F.col("c") > 0.3, "named": F.col("name").isNotNull()})
    assert took["rows"] == 3 and took["sure"] == 1 and took["named"] == 0 and took["seconds"] > 0 and took["peak_mb"] > 0
    assert "VERIFIED" in graphs.top(rows)


def test_persons_proceedings_and_fetches(spark):
    xml = "<person><author>Ann Lee</author><author>A. Lee</author><url>http://a</url><url>http://b</url><note>Uni</note></person>"
    p = spark.createDataFrame([(xml,)], "x string").select(graphs.person(F.col("x")).alias("p")).first()["p"]
    assert p["name"] == "Ann Lee" and p["names"] == ["Ann Lee", "A. Lee"] and p["homepage"] == "http://a" and p["affiliations"] == ["Uni"]
    papers = spark.createDataFrame([("V", 2020, "b"), ("V", 2020, "a"), ("W", 2021, "c")], "venue string, year int, title string")
    assert {r["venue"]: (r["papers"], r["titles"]) for r in graphs.proceedings(papers, ["venue", "year"]).collect()} == {"V": (2, ["a", "b"]), "W": (1, ["c"])}
    pages = spark.createDataFrame([("http://a.org/x/", "<p>"), ("http://a.org/y", " ")], "url string, html string")
    asked = spark.createDataFrame([("http://A.org/x",), ("http://a.org/y",), ("http://a.org/z",), ("",)], "url string")
    assert {r["url"]: r["status"] for r in graphs.fetched(asked, pages).collect()} == {"http://A.org/x": "ok", "http://a.org/y": "empty", "http://a.org/z": "missing", "": "invalid"}
    assert graphs.namespaced(pages, "lab").select("namespace").distinct().first()[0] == "lab"


def test_windows_around_a_word(spark):
    rows = spark.createDataFrame([("x" * 200 + " lab " + "y" * 50 + " 7",), ("7" + "x" * 200 + " lab",), ("nothing",), (None,)], "t string")
    assert [r[0] for r in rows.select(roster.surrounded(F.col("t"), "lab", "[0-9]")).collect()] == [True, False, False, False]
