"""What a Python worker holds at once in the Jaccard join."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from tidewater.llm import jaccard
from tidewater.llm.hashing import U

ONE = np.ones(64, np.int64), np.arange(64)


def packed(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    return list(jaccard._packer(2, 0.7, np.ones(jaccard.SLOTS, np.int64), *ONE, jaccard.TILE_DOCS)(iter([batch])))


def codes(batch):
    return sum(int.from_bytes(c.as_py()[:4], "little") for c in batch.column("codes"))


def test_long_documents_are_packed_some_segments_at_a_time():
    rng = np.random.default_rng(1)
    out = packed([" ".join(map(str, rng.integers(0, 1 << 40, 50_000))) for _ in range(30)])
    assert sum(map(codes, out)) > 1_000_000 and max(map(codes, out)) < 500_000


def test_copies_are_packed_once():
    text = " ".join(map(str, range(200)))
    one, many = (packed([text] * n) for n in (1, 50))
    assert sum(map(codes, one)) == sum(map(codes, many)) > 0


def bucket(keys, docs, rows=40):
    """Rows of one bucket; the last has all documents and segments of the first once more, under other ids and first segments."""
    rng, out = np.random.default_rng(2), []
    for _ in range(rows):
        k, d = keys // rows, docs // rows
        own = np.concatenate([np.arange(d), rng.integers(0, d, k - d)])
        code = rng.integers(0, 1 << 40, k).astype(U) << U(24) | U(1 << 16)
        order = np.argsort(code)
        raw = [rng.integers(0, 1 << 63, d).astype(U), np.full(d, 9, np.uint8), rng.integers(1, 1 << 32, (d, 2)).astype(np.uint32), np.full(d, 200, np.int32), rng.integers(0, 1 << 63, (d, 2)).astype(U)]
        out.append([1, jaccard._bytes(np.diff(code[order], prepend=U(0))), pa.compress(own[order].astype(np.uint16).tobytes(), "zstd", asbytes=True), *(x.tobytes() for x in raw)])
    sids, firsts = rng.integers(0, 1 << 63, d).astype(U), rng.integers(1, 1 << 32, (d, 2)).astype(np.uint32)
    out.append([*out[0][:3], sids.tobytes(), out[0][4], firsts.tobytes(), *out[0][6:]])
    names = ["bucket", "codes", "own", "sids", "spaces", "firsts", "sizes", "bits"]
    return [pa.RecordBatch.from_arrays([pa.array([r[0]], pa.int32()), *(pa.array([x], pa.binary()) for x in r[1:])], names) for r in out]


def test_a_bucket_takes_little_beyond_what_it_holds():
    rows, keys, docs = bucket(1_200_000, 120_000), 1_230_000, 123_000
    tracemalloc.start()
    try:
        pairs = sum(len(b) for b in jaccard._meet(0.7)(iter(rows)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # Each document of the first row meets its double in the last.
    assert pairs >= 3_000
    assert peak < 2 * (10 * keys + 36 * docs) + (20 << 20), peak


def test_ranges_of_segments_give_the_same_pairs():
    rows = bucket(40_000, 4_000)
    want, *others = (sorted(tuple(r.values()) for b in jaccard._meet(0.7, limit)(iter(rows)) for r in b.to_pylist()) for limit in (1 << 30, 5_000, 300))
    assert len(want) >= 100 and all(x == want for x in others)
