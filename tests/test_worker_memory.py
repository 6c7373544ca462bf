"""What a Python worker holds at once over a large batch of pages."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa
import pytest

from tidewater.operators import members, web

N = 800
LINKED = "<title>t</title><h2>Students</h2><ul>" + "".join(f'<li><a href="/p/{i}">Ann{chr(97 + i)} Lee</a>, PhD student</li>' for i in range(20)) + "</ul>"


@pytest.mark.parametrize(("rows_of", "rows"), [(web.links, 20 * N), (web.parsed, N), (members.members, 20 * N)])
def test_a_large_batch_of_pages_is_read_some_pages_at_a_time(spark, monkeypatch, rows_of, rows):
    pages = spark.createDataFrame([(1, "http://h.org/", LINKED)], "page_id long, url string, html string")
    kind, taken = type(pages), []
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, run, schema: taken.append(run) or plain(self, run, schema))
    assert rows_of(pages).count() == rows // N
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(N)), "url": ["http://h.org/"] * N, "html": [LINKED] * N})
    tracemalloc.start()
    try:
        found = most = 0
        for out in taken[0](iter([batch])):
            found, most = found + len(out), max(most, out.nbytes)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == rows and most < 2_000_000 and peak < 7 << 20, (found, most, peak)
