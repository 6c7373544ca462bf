"""Report queries over tables larger than the limits they once had, against plain Python."""

from __future__ import annotations

import pytest

from tidewater.plans import reports

N = 1200


@pytest.fixture(scope="module")
def customers(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    rows = [(i, f"Customer#{i * 7919 % N:05}", i % 3, float(i % 11 - 3)) for i in range(N)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double").write.parquet(f"{path}/customer.parquet")
    return path, rows


def reached(rows, root, most):
    edges = {}
    for key, _, nation, _ in rows:
        edges.setdefault(key + 1000, set()).add(nation)
        edges.setdefault(nation, set()).add(key + 1000)
    depth, level = {root: 0}, [root]
    for d in range(1, most + 1):
        level = sorted({y for x in level for y in edges.get(x, ())} - set(depth))
        depth |= {x: d for x in level}
    return depth


def test_bfs_reaches_every_customer(spark, customers):
    path, rows = customers
    want = {(r, x, d) for r in (1000, 1001, 1002) for x, d in reached(rows, r, 3).items()}
    assert {tuple(x) for x in reports.bounded_bfs(spark, path).collect()} == want and len(want) == 3 * (N // 3 + 1)


def test_page_budget_is_150_of_all_that_is_reached(spark, customers):
    path, rows = customers
    want = {(r, x, d) for r in (1000, 1001, 1002) for d, x in sorted((d, x) for x, d in reached(rows, r, 3).items())[:150]}
    assert {tuple(x) for x in reports.bfs_page_budget(spark, path).collect()} == want and len(want) == 450


def test_review_sort_numbers_every_customer(spark, customers):
    path, rows = customers
    order = sorted(rows, key=lambda r: (r[3] >= 0, r[2] < 5, r[2], r[1].lower()))
    want = [(i, key, balance < 0, nation < 5, nation) for i, (key, _, nation, balance) in enumerate(order, 1)]
    assert [tuple(r) for r in reports.multi_key_review_sort(spark, path).collect()] == want and len(want) == N


def test_prefixes_of_every_part_count(spark, tmp_path):
    names = [f"{'early' if i < 500 else 'late'} part {i}" for i in range(6000)]
    spark.createDataFrame(list(enumerate(names)), "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    assert {tuple(r) for r in reports.key_prefix_freq(spark, str(tmp_path)).collect()} == {("early", 500), ("late", 5500)}
