"""Token counts by overlap resynchronisation.

A document of more than CHUNK bytes is cut into chunks that overlap, which go to different tasks.  Each is encoded by itself with the
offsets of its tokens.  Two neighbours are spliced at a place in their overlap where both end a token and that is proven stable: no
alternative of the word pattern takes a white-space character after any other character, so a word ends between the two whatever
stands before or after, and merges never cross words.  A document with an overlap that has no such place is cut again with wider
overlaps, at last wide enough to hold the whole of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.bpe import PATTERN, VOCABULARY, vocabulary
from tidewater.llm.common import checkpointed, sized

#: Bytes of a chunk without its overlap, bytes of the first overlap, and how many times wider each next one is.
CHUNK = 64 << 10
OVERLAP = 512
WIDER = 16

RESULT = "doc_id long, n_tokens long, n_chunks int, overlap long"
_SPACE = np.zeros(256, np.bool_)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def encoding(pieces: tuple[bytes, ...]) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces)}, special_tokens={})


def cut(raw: bytes, chunk: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, where the next chunk starts, end with overlap) of each chunk, at starts of characters."""

    def character(at: int) -> int:
        while at < len(raw) and raw[at] & 0xC0 == 0x80:
            at += 1
        return min(at, len(raw))

    starts = [0]
    while starts[-1] + chunk < len(raw):
        starts.append(character(starts[-1] + chunk))
    starts = [s for s in starts if s < len(raw)] or [0]
    return [(a, b, character(min(len(raw), b + overlap)) if b < len(raw) else b) for a, b in zip(starts, [*starts[1:], len(raw)], strict=True)]


def boundaries(raw: bytes, ids: list[int], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable places of a chunk that end a token, and how many tokens come before each."""
    data = np.frombuffer(raw, np.uint8)
    stable = np.flatnonzero(_SPACE[data[1:]] & ~_SPACE[data[:-1]] & (data[:-1] < 128)) + 1
    ends = np.cumsum(lengths[np.array(ids, np.int64)])
    at = np.searchsorted(ends, stable)
    ok = (at < len(ends)) & (ends[np.minimum(at, max(len(ends) - 1, 0))] == stable) if len(ends) else np.zeros(len(stable), np.bool_)
    return stable[ok], at[ok] + 1


def _direct(pieces: tuple[bytes, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(pieces).encode_ordinary
        for batch in batches:
            counts = [None if t is None else len(encode(t)) for t in batch.column("text").to_pylist()]
            chunks = [None if n is None else 1 for n in counts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(chunks, pa.int32()), pa.array([None if n is None else 0 for n in counts], pa.int64())], ["doc_id", "n_tokens", "n_chunks", "overlap"])

    return run


def _cutter(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, key, raw in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), batch.column("raw").to_pylist(), strict=True):
                for part, (a, b, end) in enumerate(cut(raw, chunk, overlap)):
                    yield pa.RecordBatch.from_pylist([{"doc_id": doc, "key": key, "part": part, "last": b == len(raw), "start": a, "next": b, "raw": raw[a:end]}], _CUT)

    return run


_CUT = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("part", pa.int32()), ("last", pa.bool_()), ("start", pa.int64()), ("next", pa.int64()), ("raw", pa.binary())])
_PLACES = pa.list_(pa.int64())
_CODED = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("part", pa.int32()), ("last", pa.bool_()), ("n", pa.int64()), ("head", _PLACES), ("head_n", _PLACES), ("tail", _PLACES), ("tail_n", _PLACES)])


def _coder(pieces: tuple[bytes, ...], overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(pieces).encode_ordinary
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids = encode(row["raw"].decode())
                at, before = boundaries(row["raw"], ids, lengths)
                at = at + row["start"]
                head, tail = at <= row["start"] + overlap + 4, at > row["next"]
                out.append({"doc_id": row["doc_id"], "key": row["key"], "part": row["part"], "last": row["last"], "n": len(ids), "head": at[head], "head_n": before[head], "tail": at[tail], "tail_n": before[tail]})
            yield pa.RecordBatch.from_pylist(out, _CODED)

    return run


def _splice(overlap: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        copies = sum(r["part"] == 0 for r in rows)
        rows = rows[::copies]
        total, before = 0, 0
        for a, b in zip(rows, rows[1:], strict=False):
            same, i, j = np.intersect1d(np.array(a["tail"], np.int64), np.array(b["head"], np.int64), return_indices=True)
            if not len(same):
                total = None
                break
            total += a["tail_n"][i[0]] - before
            before = b["head_n"][j[0]]
        total = None if total is None else total + rows[-1]["n"] - before
        return pa.table({"doc_id": pa.array([rows[0]["doc_id"]] * copies, pa.int64()), "key": [rows[0]["key"]] * copies, "n_tokens": pa.array([total] * copies, pa.int64()), "n_chunks": pa.array([len(rows)] * copies, pa.int32()), "overlap": pa.array([overlap] * copies, pa.int64())})

    return run


def token_counts(docs: DataFrame, path: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens, n_chunks and overlap (bytes; 0 for a document in one piece) for every row of `docs`.

    An empty text has no tokens, a null text a null count.  Rows that repeat, and null doc_ids, give a row each.  Strings that name
    special tokens are ordinary text.  Other columns are ignored.
    """
    pieces = vocabulary(path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    huge = F.octet_length("text") > chunk
    short = rows.where(~F.coalesce(huge, F.lit(False))).mapInArrow(_direct(pieces), RESULT)
    # Rows alike in doc_id and text have one key: they are cut alike, and spliced once for all.
    left = rows.where(huge).select("doc_id", F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), "text"), 256).alias("key"), F.col("text").cast("binary").alias("raw"))
    longest = left.agg(F.max(F.octet_length("raw"))).first()[0] or 0
    out, wanted = short, None
    while longest:
        one = left if wanted is None else left.join(sized(wanted, 64), "key", "left_semi")
        parts = one.mapInArrow(_cutter(chunk, overlap), "doc_id long, key string, part int, last boolean, start long, next long, raw binary").repartition("key", "part")
        coded = parts.mapInArrow(_coder(pieces, overlap), "doc_id long, key string, part int, last boolean, n long, head array<long>, head_n array<long>, tail array<long>, tail_n array<long>")
        spliced = checkpointed(coded.groupBy("key").applyInArrow(_splice(overlap), "doc_id long, key string, n_tokens long, n_chunks int, overlap long"))
        out = out.unionByName(spliced.where("n_tokens is not null").drop("key"))
        wanted = spliced.where("n_tokens is null").select("key").distinct()
        if wanted.isEmpty():
            break
        overlap *= WIDER
        if overlap >= longest:
            chunk = overlap = longest
    return out


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
