"""Benchmark decontamination by pigeonhole edit matching.

An item of m bytes may occur in a document with up to k = RATE * m edits.  Cut into k + 1 pieces, it has at least one piece that no
edit touches, so every occurrence shows an exact piece at the right distance from its start.  An Aho-Corasick automaton finds all
pieces of all items in one pass over the text; around each hit Myers' bit-parallel algorithm computes the least edit distance of the
item to any substring.  The matching is exact: no occurrence within the budget is missed.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import modest, tidy, without_ids
from tidewater.llm.hashing import WORD_BYTE, buffers

#: Edits allowed for each byte of a normalised item; one whose budget is 0 must stand there as whole words.
RATE = 0.06
#: Bytes of items that one automaton holds.  Each pass over the texts runs PASS automata one after the other over every batch.
AUTOMATON_BYTES = 2 << 20
PASS = 8

LEAKS = "doc_id long, item_id long, edits int"


def normalise(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of bytes that belong to no word become one space; texts are kept apart by a line feed.  Returns bytes and offsets."""
    n = len(at) - 1
    spaced = np.full(len(data) + n, 10, np.uint8)
    own = np.ones(len(spaced), np.bool_)
    ends = at[1:] + np.arange(n)
    own[ends] = False
    spaced[own] = np.where(WORD_BYTE[data], data, 32)
    gap = spaced == 32
    follows = np.empty(len(gap), np.bool_)
    follows[:1] = True
    follows[1:] = gap[:-1] | (spaced[:-1] == 10)
    keep = ~(gap & follows)
    kept = np.cumsum(keep)
    return spaced[keep], np.concatenate([[0], kept[ends]]) if n else np.zeros(1, np.int64)


def normal(text: str) -> str:
    """A text in lower case, as `normalise` leaves it, one character for each byte."""
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    return normalise(raw, np.array([0, len(raw)]))[0].tobytes().decode("latin-1").strip("\n ")


def budget(m: int, rate: float = RATE) -> int:
    return int(m * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length, with their places."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Myers' algorithm for one item: the least edit distance to any substring of a text."""

    def __init__(self, item: str) -> None:
        self.item, self.m = item, len(item)
        self.mask, self.high = (1 << self.m) - 1, 1 << (self.m - 1)
        self.where: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            self.where[c] |= 1 << i

    def distance(self, text: str) -> int:
        if self.item in text:
            return 0
        mask, high, where = self.mask, self.high, self.where
        up, down, now, best = mask, 0, self.m, self.m
        for c in text:
            same = where.get(c, 0)
            diagonal = (((same & up) + up) ^ up) | same
            rise = down | ~(diagonal | up) & mask
            fall = up & diagonal
            if rise & high:
                now += 1
            elif fall & high:
                now -= 1
                if now < best:
                    best = now
            vertical = same | down
            rise = rise << 1 & mask
            fall = fall << 1 & mask
            up = fall | ~(vertical | rise) & mask
            down = rise & vertical
        return best


def _whole(item: str, text: str, at: int) -> bool:
    """Whether the item at this place of a normalised text begins and ends where words do."""
    end = at + len(item)
    return (at == 0 or text[at - 1] in " \n") and (end == len(text) or text[end] in " \n")


def _matcher(groups: list[list[tuple[int, str]]], rate: float):
    def automaton(items: list[tuple[int, str]]) -> tuple[list[tuple[int, Pattern, int]], ahocorasick.Automaton]:
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        known = [(i, Pattern(text), budget(len(text), rate)) for i, text in items]
        for which, (_, pattern, k) in enumerate(known):
            for start, piece in pieces(pattern.item, k):
                found[piece].append((which, start + len(piece) - 1))
        machine = ahocorasick.Automaton()
        for piece, uses in found.items():
            machine.add_word(piece, uses)
        machine.make_automaton()
        return known, machine

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = [automaton(items) for items in groups]
        # Normalising takes many times a text's bytes, so it takes some rows at a time.
        for batch in (b.slice(start, 256) for b in batches for start in range(0, len(b), 256)):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            raw, at = normalise(*buffers(batch.column("text")))
            text = raw.tobytes().decode("latin-1")
            docs, which_items, edits = [], [], []
            for known, machine in machines:
                # A piece lies in one row; hits of one item whose windows meet are one window.
                places: dict[tuple[int, int], list[int]] = defaultdict(list)
                hits = [(end, end - last, which) for end, uses in machine.iter(text) for which, last in uses]
                if hits:
                    rows = np.searchsorted(at, np.array([h[0] for h in hits]), side="right") - 1
                    for row, (_, start, which) in zip(rows.tolist(), hits, strict=True):
                        places[(row, which)].append(start)
                for (row, w), starts in places.items():
                    item, pattern, k = known[w]
                    if not k:
                        if any(_whole(pattern.item, text, start) for start in starts):
                            docs.append(row), which_items.append(item), edits.append(0)
                        continue
                    best = k + 1
                    low, high = int(at[row]), int(at[row + 1])
                    starts.sort()
                    i = 0
                    while i < len(starts) and best:
                        a = starts[i] - k
                        b = starts[i] + pattern.m + k
                        while i + 1 < len(starts) and starts[i + 1] - k <= b:
                            i += 1
                            b = starts[i] + pattern.m + k
                        window = text[max(low, a) : min(high, max(b, 0))]
                        if len(window) >= pattern.m - k:
                            best = min(best, pattern.distance(window))
                        i += 1
                    if best <= k:
                        docs.append(row), which_items.append(item), edits.append(best)
            yield pa.RecordBatch.from_arrays([pa.array(ids[docs] if docs else ids[:0]), pa.array(which_items, pa.int64()), pa.array(edits, pa.int32())], ["doc_id", "item_id", "edits"])

    return run


def item_groups(benchmark: DataFrame, limit: int = AUTOMATON_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The normalised items, in groups of at most `limit` bytes (an item that is longer makes a group of its own).  One without any letter
    or digit has nothing to match."""
    group, size = [], 0
    for item, text in benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null").orderBy("item_id", "text").toLocalIterator():
        text = normal(text)
        if not text:
            continue
        if group and size + len(text) > limit:
            yield group
            group, size = [], 0
        group.append((item, text))
        size += len(text)
    if group:
        yield group


def _some(groups: Iterator[list], n: int) -> Iterator[list[list]]:
    while held := list(itertools.islice(groups, n)):
        yield held


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id and edits: the items that occur in each document within the error budget, with the least edit distance found.

    Texts are compared in lower case with runs of anything but letters and digits as one space, by bytes of UTF-8.  An item too short
    for any edit must occur as whole words.  Items without a letter or digit, null texts and null ids match nothing; texts may have any
    length; rows that share a doc_id or an item_id give the least distance of any.  Other columns are ignored.  The automata are sent to
    the tasks, PASS of bounded size at a time: more items take more passes.
    """
    text = modest(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text")).where("doc_id is not null and text is not null")
    out = None
    for groups in _some(item_groups(benchmark), PASS):
        found = text.mapInArrow(tidy(_matcher(groups, rate)), LEAKS)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return text.select("doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0).alias("edits")).where(F.lit(False))
    return out.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """`docs` less the documents in which an item occurs; columns as they came, rows with a null text or doc_id stay.  All rows of a doc_id
    go if an item occurs in one of them."""
    return without_ids(docs, leaks(docs, benchmark, rate))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`leaks` of all of `benchmark` in all documents."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
