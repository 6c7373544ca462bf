from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from tidewater.functions import text
from tidewater.operators import bibliography as bib
from tidewater.operators import graph, matching, members, sequences, web
from tidewater.sources import bibliography as source
from tidewater.sources import sinks
from tidewater.storage import blocks
from tidewater.streaming import windows


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "c string").select(column(F.col("c"))).collect()]


def test_scalars(spark):
    assert one(spark, text.without_disambiguator, "Ann Lee 0001", "Ann Lee") == ["Ann Lee", "Ann Lee"]
    assert one(spark, text.affiliation_key, " Univ. of  X, Y ", None) == ["univ of x y", None]
    assert one(spark, text.name_key, "Dr. Ann  Lee, PhD") == ["ann lee"]
    assert one(spark, text.fetchable, "example.org", "http://a.b", " ") == ["https://example.org", "http://a.b", None]
    assert one(spark, text.bare_host, "https://www.Example.org:80/x", "nonsense") == ["example.org", None]
    assert one(spark, text.url_key, "HTTP://Ex.org//A//index.html?q=1#f", "http://ex.org/", "http://ex.org") == ["http://ex.org/a?q=1", "http://ex.org", "http://ex.org"]
    assert one(spark, text.title, "<TITLE lang=x> a \n b </title>") == ["a b"] and one(spark, text.visible, "<p>A<script>x</script> b</p>") == ["a b"]
    assert one(spark, text.person_like, "Ann Lee", "ANN LEE", "Ann 2", "ann lee", "Ann-Marie O'Neil", "Ann") == [True, False, False, False, True, False]


def test_gazetteer_tiers(spark):
    gazetteer = spark.createDataFrame([("University of Here", ["UH", "Here U"], "X", 1), ("Berlin, Free Univ", [], "D", 2)], "canonical string, aliases array<string>, country string, ord int")
    rows = spark.createDataFrame([(1, "University of Here"), (2, "Dept. Z, UH"), (3, "The University of Here West"), (4, "Berlin, Free Univ"), (5, "nowhere"), (6, None)], "k int, raw string")
    got = {r["k"]: (r["canonical"], r["confidence"]) for r in matching.gazetteer_match(rows, gazetteer, "k", "raw").collect()}
    assert got == {1: ("University of Here", 1.0), 2: ("University of Here", 0.85), 3: ("University of Here", 0.6), 4: ("Berlin, Free Univ", 1.0), 5: (None, 0.0), 6: (None, 0.0)}


def test_greedy_merge_is_by_order_and_not_transitive(spark):
    rows = spark.createDataFrame([("p", 1, "Ann Lee"), ("p", 2, "Ann B Lee"), ("p", 3, "B Lee"), ("p", 4, "Lee"), ("q", 1, "Ann Lee")], "g string, pos int, name string")
    got = {(r["g"], r["leader"]): r["n"] for r in matching.greedy_merge(rows, "g", "name", "pos").collect()}
    assert got == {("p", "Ann Lee"): 2, ("p", "B Lee"): 1, ("p", "Lee"): 1, ("q", "Ann Lee"): 1}


def test_compared_and_ranked(spark):
    old, new = spark.createDataFrame([("a", 1), ("b", 5), ("c", 2)], "k string, v int"), spark.createDataFrame([("b", 7), ("c", 2), ("d", 1)], "k string, v int")
    got = {r["k"]: (r["delta"], r["status"]) for r in matching.compared(old, new, "k", "v").collect()}
    assert got == {"a": (-1, "removed"), "b": (2, "improved"), "c": (0, "unchanged"), "d": (1, "added")}
    assert [(r["rank"], r["k"]) for r in bib.ranked(new, [F.desc("v"), F.asc("k")], 2).orderBy("rank").collect()] == [(1, "b"), (2, "c")]
    scores = spark.createDataFrame([(20, 25.0, 5, 1.0), (0, 0.0, 0, 0.0)], "n int, v double, a int, s double")
    assert [r[0] for r in scores.select(bib.overall(F.col("n"), F.col("v"), F.col("a"), F.col("s"), 20.0)).collect()] == [100.0, 0.0]


def test_sequences(spark):
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate("xxyyyx")] + [("b", 0, None), ("b", 1, None)], "g string, i int, v string")
    assert [(r["g"], r["v"], r["n"]) for r in sequences.runs(rows, "g", ["i"], "v").orderBy("g", "run").collect()] == [("a", "x", 2), ("a", "y", 3), ("a", "x", 1), ("b", None, 2)]
    got = sequences.carried(rows, "g", ["i"], F.when(F.col("v") == "y", F.col("i"))).where("g = 'a'").orderBy("i").collect()
    assert [r["section"] for r in got] == [None, None, 2, 3, 4, 4]
    assert spark.createDataFrame([(x,) for x in (4, 1, 3, 2)], "x int").agg(sequences.upper_median("x")).first()[0] == 3


def test_bfs_ends_on_cycles_and_keeps_the_least_depth(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "d"), ("d", "e")], "src string, dst string")
    got = {r["node"]: r["depth"] for r in graph.bounded_bfs(edges, spark.createDataFrame([("a",)], "root string"), 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2}
    assert graph.budgeted(graph.bounded_bfs(edges, spark.createDataFrame([("a",)], "root string"), 3), 3).count() == 3


HOME = """<html><head><title>Ann Lee</title><base href="http://ex.org/ann/"><link rel="canonical" href="http://new.ex.org/ann"><meta http-equiv="Refresh" content="0; URL='http://moved.ex.org/'"></head>
<body><nav><a href="/lab/">My Lab</a><a href="#x">skip</a><a href="mailto:a@b.c">mail</a></nav><script>var a='<a href="/no">no</a>'</script><p>See the <a href="people.html">people</a> of the group and <a href="http://other.org/">others</a>.</p>
<p><a href="PEOPLE.html#x">People</a></p></body></html>"""


def test_links_slots_and_recovery(spark):
    pages = spark.createDataFrame([(1, "http://ex.org/home", HOME), (2, "http://ex.org/none", None), (3, None, "")], "page_id long, url string, html string")
    rows = web.links(pages).orderBy("pos").collect()
    assert [(r["anchor"], r["url"], r["side"]) for r in rows] == [("My Lab", "http://ex.org/lab/", True), ("people", "http://ex.org/ann/people.html", False), ("others", "http://other.org/", False), ("People", "http://ex.org/ann/PEOPLE.html#x", False)]
    assert web.distinct_links(web.links(pages)).count() == 4
    slots = [("people", "people", "anchor"), ("people", "people", "path"), ("lab", "lab", "anchor")]
    got = {r["slot"]: (r["pos"], r["score"]) for r in web.slots(web.links(pages), slots).collect()}
    assert got == {"people": (1, 0.965), "lab": (0, 0.585)}
    facts = web.parsed(pages).withColumn("final_url", F.lit(None).cast("string"))
    assert [(r["to"], r["method"]) for r in web.recovered(facts).collect()] == [("http://moved.ex.org/", "meta_refresh")]
    assert [r["url"] for r in web.nearby_pages(web.links(pages), ["people"]).collect()] == ["http://ex.org/ann/people.html"]
    assert [(r["anchor"], r["confidence"]) for r in web.labs(web.links(pages), ["lab"]).orderBy("rk").collect()][0] == ("My Lab", 0.85)


def test_scores(spark):
    row = spark.range(1)
    f = lambda c: row.select(c).first()[0]
    lit = F.lit
    yes, no = lit(True), lit(False)
    score = lambda *x: f(web.person_score(*map(lit, x)))
    assert score(2, True, True, 2, True, True, True, False) == 1.0 and score(2, True, True, 2, True, True, True, True) == 0.0
    # An address of any kind and an e-mail: the better of both; no section's name, no .05.
    assert score(2, True, False, 0, False, True, True, False) == 0.65 and score(1, True, True, 1, False, True, False, False) == 0.58
    assert score(0, True, True, 2, True, True, True, False) == score(2, False, True, 2, True, True, True, False) == score(2, True, True, 0, False, True, False, False) == 0.0
    assert f(web.candidate_score(lit(0.5), lit(0.1), lit(0.9), lit(0.0), lit(1.0), lit(0.2), lit(True))) == 0.6
    assert [f(web.member_cap(lit(d), lit(c), lit(n))) for d, c, n in ((True, 0.8, 5), (True, 0.5, 5), (False, 0.0, 61), (False, 0.0, 60))] == [20, 30, 60, None]
    state = lambda *x: tuple(f(c) for c in web.identity_state(*map(lit, x)))
    assert state(True, True, False, False, False, False, False) == ("VERIFIED", 1.0) and state(False, True, True, True, True, True, True) == ("INVALID", 0.0)
    assert state(False, False, True, True, False, False, False) == ("RESOLVABLE", 0.85) and state(False, False, True, False, True, False, False) == ("RESOLVABLE", 0.75)
    assert state(False, False, True, False, False, False, True) == ("PARTIAL", 0.55) and state(False, False, True, False, False, False, False) == ("INVALID", 0.0)
    assert one(spark, web.identity_kind, "https://github.com/ann", "https://github.com/ann/x", "https://orcid.org/0", "https://www.linkedin.com/in/a", "http://ex.org") == ["github", "repository", "orcid", "linkedin", "homepage"]
    assert f(web.extraction_confidence(lit(1.0), lit(True), lit(True), lit(False), lit(True))) == 1.0 and f(web.talent_confidence(lit(0.5), lit(9), lit(True))) == 0.9
    scope = lambda *x: tuple(f(c) for c in web.department_scope(*map(lit, x)))
    assert scope(0.25, 0.3, 31, 0, 0, False) == (True, 0.65) and scope(0.0, 0.0, 120, 20, 0, False) == (False, 0.65) and scope(0.0, 0.0, 120, 20, 15, True) == (True, 0.75)
    assert scope(0.25, 0.3, 25, 2, 15, True) == (False, 0.325) and scope(0.25, 0.3, 25, 3, 15, True) == (True, 0.65)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<h2>People</h2><ul><li><a href='/a'>Ann Lee</a>, PhD student</li><li>Bob Ray - postdoc</li></ul><h2>Alumni</h2><ul><li>Cal Moe (2019)</li></ul><h2>Publications</h2><ul><li>Dan Fox, Eve Hill</li></ul>", [("Ann Lee", "current", "list"), ("Bob Ray", "current", "list"), ("Cal Moe", "former", "list")]),
        ("<p><strong>Current students</strong></p><ul><li>Ann Lee</li></ul>", [("Ann Lee", "current", "list")]),
        ("<h2>Team</h2><table><tr><td>Ann Lee</td><td>Engineer</td></tr><tr><td>Bob Ray</td><td>Intern</td></tr></table>", [("Ann Lee", "current", "table"), ("Bob Ray", "current", "table")]),
        ("<h3>Ann Lee</h3><p>PhD student</p><h3>Bob Ray</h3><p>Postdoc</p><h3>Cal Moe</h3><p>Researcher</p>", [("Ann Lee", None, "heading"), ("Bob Ray", None, "heading"), ("Cal Moe", None, "heading")]),
        ("<h3>Ann Lee</h3><p>PhD student</p><h3>Bob Ray</h3><p>Postdoc</p>", []),
        ("<h2>Members</h2><dl><dt>Ann Lee</dt><dd>x</dd></dl>", [("Ann Lee", "current", "definition")]),
        ("<p>Ann Lee, PhD student</p><p>Bob Ray, postdoc</p><p>Cal Moe, intern</p>", [("Ann Lee", None, "paragraph"), ("Bob Ray", None, "paragraph"), ("Cal Moe", None, "paragraph")]),
        ("<nav><ul><li>Ann Lee</li></ul></nav>", []), ("", []), ("<ul><li>", []),
    ],
)
def test_members(page, want):
    assert [(e["name"], e["status"], e["layout"]) for e in members.entries(page, "http://ex.org/")] == want


def test_entities_are_repaired_wherever_chunks_are_cut():
    raw = "<t a='1'>A &amp; B &uuml; &#233; &nosuch; & C > D &lt; &alpha;x</t>"
    want = "<t a='1'>A &amp; B ü &#233; &amp;nosuch; &amp; C &gt; D &lt; αx</t>"
    for size in (1, 2, 3, 7, 1000):
        assert "".join(source.repaired(raw[i : i + size] for i in range(0, len(raw), size))) == want


def test_xml_sources(spark, tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(
        '<dblp><inproceedings key="conf/x/1"><author pid="1">Ann Lee</author><author>Bob Ray 0001</author><title>Fast kernels</title><booktitle> X </booktitle><year>2001</year><ee>http://e/1</ee><ee>http://e/2</ee></inproceedings>'
        '<inproceedings key="conf/x/2"><title>No year</title><booktitle>X</booktitle><year>soon</year></inproceedings>'
        '<www key="homepages/1"><author>Ann Lee</author><author>A. Lee</author><note type="affiliation">Here U</note><note>no</note><url>https://denied.org/a</url><url>http://ann.org</url><url>https://orcid.org/7</url></www><www key="other/2"><author>X</author></www></dblp>'
    )
    rows = source.papers(spark, str(path), partitions=2).collect()
    assert [(r["dblp_key"], r["venue"], r["year"], [a["name"] for a in r["authors"]], r["ee_url"]) for r in rows] == [("conf/x/1", "X", 2001, ["Ann Lee", "Bob Ray 0001"], "http://e/1")]
    assert bib.exploded_authors(source.papers(spark, str(path))).count() == 2
    found = source.people(spark, str(path), ["denied.org", "orcid.org"])
    r = found.first()
    assert found.count() == 1 and (r["name"], r["homepage"], r["orcid"], r["affiliations"]) == ("Ann Lee", "http://ann.org", "https://orcid.org/7", ["Here U"])
    assert source.targets(found, spark.createDataFrame([("a. lee",)], "name string")).first()["matched_alias"] == "A. Lee"
    assert source.landed(found, f"{tmp_path}/landed").count() == 1 and source.repair_file(str(path), f"{tmp_path}/clean.xml").endswith("clean.xml")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1, ["x", "y"]), ("ü<", 2, None)], "k string, n int, l array<string>")
    assert sinks.markdown(df) == "| k | n | l |\n| --- | --- | --- |\n| a\\|b | 1 | x; y |\n| ü< | 2 |  |\n"
    sinks.json_array(df, f"{tmp_path}/a.json")
    assert "ü" in (tmp_path / "a.json").read_text() and "&lt;" in sinks.html_table(df, "t")
    sinks.csv(df, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2
    sinks.frequencies(df, "k", f"{tmp_path}/freq")
    sinks.workbook(df, f"{tmp_path}/a.xlsx", by="n")
    sheet = zipfile.ZipFile(f"{tmp_path}/a.xlsx").read("xl/worksheets/sheet1.xml").decode()
    assert sheet.index("ü&lt;") < sheet.index("a|b")
    with pytest.raises(ValueError, match="more than 1 rows"):
        sinks.markdown(df, most=1)


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    for name, make in (("w", lambda d: windows.window_counts(d, "1 hour")), ("s", lambda d: windows.sessions(d, "1 hour"))):
        q = make(stream).writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{tmp_path}/c{name}").start()
        q.processAllAvailable()
        q.stop()
        assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, make(events).collect()))


def test_affinity_counts_aliases(spark):
    papers = spark.createDataFrame([(1, "SOSP"), (1, "Proc. Symposium on Operating Systems Principles 2020"), (1, "else"), (1, None), (2, "sospx")], "person int, venue string")
    aliases = [("SOSP", ["symposium on operating systems principles"])]
    plain = {r["person"]: r["affinity"] for r in bib.affinity(papers, ["SOSP"]).collect()}
    wide = {r["person"]: r["affinity"] for r in bib.affinity(papers, ["SOSP"], aliases=aliases).collect()}
    assert plain == {1: 0.25, 2: 0.0} and wide == {1: 0.5, 2: 0.0}


def test_blocks_hold_every_row_once(spark):
    rows = spark.createDataFrame([("a", f"w{i % 90}") for i in range(100)], "category string, term string")
    parts = blocks(rows, 512, 4096)
    assert len(parts) == 13
    assert sorted(r["term"] for p in parts for r in p.collect()) == sorted(r["term"] for r in rows.collect())
