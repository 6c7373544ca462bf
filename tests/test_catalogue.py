"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tidewater.plans import catalogue

SD = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, list | tuple):
        return tuple(map(plain, value))
    return value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = Path(SD, f"{t}.parquet")
        con.sql(f"create view {t} as select * from '{path if path.is_file() else path / '*.parquet'}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    got = catalogue.queries()[name](spark, SD)
    rows = got.collect()
    if name not in catalogue.oracle_sql():
        assert len(got.columns) == len(set(got.columns))
        return
    want = duck.sql(catalogue.oracle_sql()[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    a = sorted(([plain(r[c]) for c in columns] for r in rows), key=repr)
    b = sorted(([plain(r[want.columns.index(c)]) for c in columns] for r in want.fetchall()), key=repr)
    assert a == b


def test_entry_works_without_the_corpus_operators(tmp_path):
    """The rest imports when the folders of the corpus operators are gone."""
    root = Path(__file__).resolve().parent.parent
    for x in ("__spark_entry__.py", "tidewater"):
        (tmp_path / x).parent.mkdir(parents=True, exist_ok=True)
        if (root / x).is_file():
            (tmp_path / x).write_bytes((root / x).read_bytes())
    for p in (root / "tidewater").rglob("*.py"):
        if "llm" not in p.parts:
            (tmp_path / p.relative_to(root)).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / p.relative_to(root)).write_bytes(p.read_bytes())
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert out.stdout.split() == [str(len(catalogue.queries())), "False"], out.stderr
