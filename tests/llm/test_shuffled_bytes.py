"""What the Jaccard join leaves on disk: segments and sets on their way, and shuffles that have served."""

from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidewater.llm import jaccard
from tidewater.llm.common import CLEAN_UP, settled

from .test_dedup import words


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])


def held(spark):
    """Bytes of shuffle files."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_"))


def test_a_segment_takes_few_bytes():
    rng = random.Random(1)
    out = list(jaccard._packer(2, 0.7, np.ones(jaccard.SLOTS, np.int64), np.full(64, 5), 5 * np.arange(64), jaccard.TILE_DOCS)(iter([batch([" ".join(words(rng, 400)) for _ in range(1_500)])])))
    codes = [c.as_py() for b in out for c in b.column("codes")]
    assert sum(map(len, codes)) < 3.3 * sum(int.from_bytes(c[:4], "little") for c in codes)


def test_sets_go_as_texts_where_these_are_shorter_and_come_back_the_same():
    rng = random.Random(2)
    usual = [" ".join(words(rng, 300)) for _ in range(300)]
    # Few n-grams in a long text, one in a short text, characters beyond ASCII, a text that is longer than a block.
    odd = ["the " * 50_000, "x", "\u00e9t\u00e9 \u4e2d\u6587 " * 3, "", None, " - ", " ".join(words(rng, 150_000))]
    sent = pa.Table.from_batches(jaccard._sets(2)(iter([batch([*usual[:150], *odd, *usual[150:]])])))
    known = [g for _, g in jaccard._grams(batch([*usual[:150], *odd, *usual[150:]]), 2)]
    back = jaccard._unpacked(sent.column("body"), 2)
    assert len(back) == len(known) == 304 and all(np.array_equal(a, b) for a, b in zip(back, known, strict=True))
    assert {b.as_py()[:1] for b in sent.column("body")} == {b"s", b"t"}
    assert sum(len(b.as_py()) for b in sent.column("body")) < 0.6 * sum(8 * len(g) for g in known)
    # Nothing grows beyond twice the memory of the sets.
    assert all(b[:1] == b"s" or int.from_bytes(b[1:5], "little") <= 16 * len(g) for b, g in zip(sent.column("body").to_pylist(), known, strict=True))


def test_invalid_bytes_come_back_the_same():
    raw = pa.array([b"caf\xe9 \xff one two three four"] * 2, pa.binary()).view(pa.string())
    both = pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int64()), raw], ["doc_id", "text"])
    with np.errstate(over="ignore"):
        grams = [g for _, g in jaccard._grams(both, 2)]
        bodies = pa.chunked_array([pa.array([b"t" + len(t).to_bytes(4, "little") + pa.compress(t, "zstd", asbytes=True) for t in raw.cast(pa.binary()).to_pylist()], pa.binary())])
    assert all(np.array_equal(a, b) for a, b in zip(jaccard._unpacked(bodies, 2), grams, strict=True))


def test_shuffles_that_have_served_are_gone(spark):
    counts = spark.range(300_000).groupBy((F.col("id") * 7 % 100_003).alias("k")).count()
    before, setting = held(spark), spark.conf.get(CLEAN_UP)
    out = settled(counts)
    for _ in range(40):
        if (left := held(spark) - before) <= 0:
            break
        time.sleep(0.25)
    assert left <= 0
    assert spark.conf.get(CLEAN_UP) == setting
    assert out.count() == counts.count() == counts.count() == 100_003
