"""The queries over papers: tasks take so many lines each whatever the session's partitions are, and odd tables give the rows of their SQL."""

from __future__ import annotations

import re
from functools import partial

import duckdb
import pytest

from tests.test_catalogue import plain
from tidewater import storage
from tidewater.plans import catalogue, tables

SD, LINES, N = "/root/testdata/sf0.001", 6_000, 13
BY_PERSON = ("person_paper_counts", "venue_histogram_long", "distinct_venue_score", "favoured_top3")
QUERIES = (*BY_PERSON, "export_labelled", "weighted_venue_score", "yearly_histogram_long", "affinity_share", "activity_span", "export_short", "flagship_ranking", "priority_bands", "venue_year_selection", "proceedings_groups")
EAGER = ("legacy_vs_new_scores", "top100_overlap")


@pytest.fixture
def many_tasks(monkeypatch):
    """As over large tables: parts are merged, and a task takes a few hundred lines."""
    monkeypatch.setattr(tables, "tasks", lambda lines: storage.tasks(lines, -(-LINES // N)), raising=False)
    monkeypatch.setattr(tables, "joined", partial(getattr(storage, "joined", print), limit=0), raising=False)


def exchanges(df):
    """(keys, partitions) of each exchange by hash."""
    return [(re.sub(r"#\d+L?", "", keys), int(n)) for keys, n in re.findall(r"Exchange hashpartitioning\((.*?), (\d+)\)", df._jdf.queryExecution().executedPlan().toString())]


@pytest.mark.parametrize("name", QUERIES)
def test_tasks_take_a_few_lines_each(spark, many_tasks, name):
    found = exchanges(catalogue.queries()[name](spark, SD))
    assert {k: n for k, n in found if k.startswith(("l_", "o_orderkey", "p_"))} == dict.fromkeys(("l_partkey", "p_partkey", "l_orderkey", "o_orderkey"), N)
    if name in BY_PERSON:
        assert [(k, n) for k, n in found if "person" in k or "o_custkey" in k] in ([("person", N)], [("o_custkey", N)])


@pytest.mark.parametrize("name", [q for q in QUERIES if "rank" in q or "export" in q or q == "priority_bands"])
def test_scores_join_the_papers_once(spark, many_tasks, name):
    found = [k for k, _ in exchanges(catalogue.queries()[name](spark, SD))]
    assert found.count("l_orderkey") == (2 if name == "export_short" else 1)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Tables with nulls in keys and values, orders twice, parts twice, and a person with most orders."""
    path = str(tmp_path_factory.mktemp("odd"))
    words = ["bolt rod", "gear plate", "anvil", "Bolt", None, "widget ring gizmo", ""]
    brands = ["Brand#1", "Brand#12", "Brand#7", "Brand#40", None]
    parts = [(i % 36 if i % 9 else None, words[i % 7], brands[i % 5]) for i in range(40)]
    orders = [(i % 110 if i % 13 else None, None if i % 10 == 3 else 1 if i % 2 else i % 12, f"{1994 + i % 5}-01-0{1 + i % 9}" if i % 11 else None) for i in range(130)]
    lines = [(i * 7 % 115 if i % 17 else None, i * 5 % 38 if i % 19 else None) for i in range(900)]
    for name, rows, kinds in (("part", parts, "p_partkey long, p_name string, p_brand string"), ("orders", orders, "o_orderkey long, o_custkey long, _d string"), ("lineitem", lines, "l_orderkey long, l_partkey long")):
        df = spark.createDataFrame(rows, kinds)
        (df.selectExpr("o_orderkey", "o_custkey", "cast(_d as timestamp_ntz) as o_orderdate") if name == "orders" else df).write.parquet(f"{path}/{name}.parquet")
    con = duckdb.connect()
    for name in ("part", "orders", "lineitem"):
        con.sql(f"create view {name} as select * from '{path}/{name}.parquet/*.parquet'")
    return path, con


@pytest.mark.parametrize("name", [*QUERIES, *EAGER])
def test_odd_tables(spark, many_tasks, odd, name):
    path, con = odd
    want = con.sql(catalogue.oracle_sql()[name])
    columns = sorted(want.columns)
    a = sorted(([plain(r[c]) for c in columns] for r in catalogue.queries()[name](spark, path).collect()), key=repr)
    b = sorted(([plain(r[want.columns.index(c)]) for c in columns] for r in want.fetchall()), key=repr)
    assert a == b and a
