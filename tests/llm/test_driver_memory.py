"""What the driver holds for the encoding."""

from __future__ import annotations

import tracemalloc
import zlib

import pyarrow as pa
import regex
from pyspark.sql import functions as F

from tidewater.llm import bpe


def test_descriptions_of_the_plan_do_not_spell_out_the_rank_map(spark):
    docs = spark.createDataFrame([(1, "some words, and some more"), (2, None)], "doc_id long, text string")
    out = bpe.round_trip(docs)
    # The driver logs and keeps one for each execution and each change of its plan.
    assert len(out._jdf.queryExecution().toString()) < 100_000
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "some words, and some more", 2: None}


def test_literals_hold_what_they_are_made_of(spark):
    for values in ([], [-1, 0, 1 << 40], ["", "ab", "é,"]):
        kind = pa.string() if values and isinstance(values[0], str) else pa.int64()
        literal = bpe._literal(pa.array(values, kind))
        got = spark.range(2).select(F.transform(F.array(literal), lambda x: x)[0].alias("all"), F.get(literal, F.col("id").cast("int") + 1).alias("one")).collect()
        assert [(r["all"], r["one"]) for r in got] == [(values, values[k] if k < len(values) else None) for k in (1, 2)]


def test_classes_are_found_without_an_object_for_each_character():
    tracemalloc.start()
    try:
        table = zlib.decompress(bpe.classes.__wrapped__())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 24 << 20, peak
    for i in [*range(0x3000), *range(0xD7F0, 0xE010), 0x1D7D8, 0x10FFFF]:
        c = chr(i)
        kind = next((k for k, name in ((bpe.LETTER, r"\p{L}"), (bpe.NUMBER, r"\p{N}"), (bpe.SPACE, r"\s")) if regex.match(name, c)), bpe.SYMBOL)
        assert table[i] == kind, i
