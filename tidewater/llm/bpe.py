"""Byte-level BPE encoding and decoding.

Texts are cut into words and blocks of texts keep each distinct word once.  The words of all blocks meet by hash, so that every distinct
word of the corpus goes once through Spark's higher-order functions, as a byte array: `aggregate` folds the ranked merges over it.  Its
state holds the token ids and the rank of every neighbouring pair, and each step replaces the leftmost pair of the least rank.  The rank
map is a literal of the plan, laid out as a displaced table in an array, because a lookup in Spark's own map type reads its keys one
after the other; it is held in binary form, which descriptions of the plan don't spell out.  The ids go back to the blocks, which put
those of their documents together.  Decoding concatenates the binary pieces of the ids.

A word of any length takes this way.  As the fold is quadratic, one of more than WINDOW bytes is folded in windows that overlap by half
and is spliced where two windows have a token in common: a sequence of tokens is the encoding of its bytes if every two neighbours are
the encoding of theirs, and on either side of a common token all neighbours come from one window.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import modest, tidy, tidy_group, tidy_groups
from tidewater.llm.hashing import P, P_INV, U, mix

#: The vocabulary, read by the driver alone, and the pattern that cuts texts into words, which `_words` follows without running it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text in one block, and of those that are cut into words at a time.
BLOCK_CHARS = 8 << 20
CHUNK = 1 << 18
#: Bytes of a word that are folded at once.
WINDOW = 64
#: Bytes of input for each group of words and blocks, beyond the session's number of shuffle partitions.
PLACE_BYTES = 64 << 20
#: Bits of an id in the rank map, and the rank of a pair that is never merged.
BITS = 20
NEVER = 1 << BITS

LETTER, NUMBER, SYMBOL, SPACE, APART = 1, 2, 0, 3, 4
PART = "place int, block long, target int, words binary, docs array<long>, some array<boolean>, counts array<int>, refs binary, buckets binary, windows array<array<int>>, longer array<binary>"
DISTINCT = "words array<array<smallint>>, refs binary, blocks array<long>, targets array<int>, counts array<int>, bucket int"
ANSWER = "place int, block long, bucket int, ids binary, sizes binary"
ENCODED = "doc_id long, ids array<int>"


@functools.lru_cache(4)
def vocabulary(path: str = VOCABULARY) -> tuple[bytes, ...]:
    """The pieces by id."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(piece) for piece, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))) or len(ranks) > NEVER:
        raise ValueError(f"{path} has no ranks from 0 on")
    return tuple(ranks[i] for i in range(len(ranks)))


@functools.lru_cache(2)
def rank_map(pieces: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The rank map as a displaced table: the entry of ids a and b is at shift[a] + b and holds the id of their merge and, above it, a.

    Every pair of pieces that make a piece has an entry.  The rows of a are laid over one another so that no two entries meet."""
    ids = {p: i for i, p in enumerate(pieces)}
    rows: dict[int, list[tuple[int, int]]] = {}
    for p, i in ids.items():
        for k in range(1, len(p)):
            if (a := ids.get(p[:k])) is not None and (b := ids.get(p[k:])) is not None:
                rows.setdefault(a, []).append((b, i))
    shift, taken = np.zeros(len(pieces) + 1, np.int64), 0
    for a, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        # Bits of one large integer stand for the places: those where some entry of the row would meet another.
        met, own = 0, 0
        for b, _ in row:
            met |= taken >> b
            own |= 1 << b
        shift[a] = at = (~met & (met + 1)).bit_length() - 1
        taken |= own << at
    table = np.full(int(shift.max(initial=0)) + len(pieces) + 1, (NEVER - 1) << BITS, np.int64)
    for a, row in rows.items():
        for b, i in row:
            table[shift[a] + b] = a << BITS | i
    return shift, table


def heap_merged(word: bytes, ids: dict[bytes, int]) -> list[int]:
    """The ids of one word, by merging the leftmost pair of the least rank until none is left."""
    parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap = [(r, i, 2) for i in range(len(word) - 1) if (r := ids.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int, j: int) -> None:
        if i >= 0 and j < len(word) and (r := ids.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (r, i, len(parts[i]) + len(parts[j])))

    while heap:
        _, i, n = heapq.heappop(heap)
        if parts[i] is None or (j := after[i]) >= len(word) or len(parts[i]) + len(parts[j]) != n:
            continue
        parts[i], parts[j] = parts[i] + parts[j], None
        after[i] = k = after[j]
        if k < len(word):
            before[k] = i
        offer(before[i], i)
        offer(i, k)
    return [ids[p] for p in parts if p is not None]


def _let(value: Column, s: Column, body) -> Column:
    """`body` of s and a value that is computed once.  Of the ways to bind a value, aggregate alone doesn't derive its type row by row."""
    return F.aggregate(F.array(value), s, body)


def _literal(values: pa.Array) -> Column:
    """An array as one literal, in the binary form of Spark's rows.

    The driver describes a plan over and over, for its log and its listeners, and keeps the descriptions.  Arrays of other forms are
    spelt out there value by value, megabytes each time; this one is named by its hash."""
    spark = SparkSession.active()
    kind = pa.list_(pa.field("element", values.type, nullable=False))
    one = spark.createDataFrame(pa.table({"x": pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values, type=kind)}))
    array = one._jdf.queryExecution().executedPlan().executeCollect()[0].getArray(0).copy()
    spark_sql = spark._jvm.org.apache.spark.sql
    return Column(spark_sql.classic.ExpressionUtils.column(spark_sql.catalyst.expressions.Literal(array, one._jdf.schema().apply(0).dataType())))


def _bound(literals: list[Column], body, *names: Column) -> Column:
    """`body` of literals that stand in the plan once, however often it uses them."""
    if not literals:
        return body(*names)
    return F.transform(F.array(literals[0]), lambda x: _bound(literals[1:], body, *names, x))[0]


def merged(pieces: tuple[bytes, ...]):
    """A function of a column of words (arrays of bytes) that gives the columns of their ids.

    A token in the state of the fold is one integer: the rank of the pair that it begins, and its id.  The state begins with an edge
    that tells whether a step has found nothing to merge, after which the steps that are left do nothing."""
    ids = {p: i for i, p in enumerate(pieces)}
    shift, table = (_literal(pa.array(x)) for x in rank_map(pieces))
    single = np.array([ids[bytes([b])] for b in range(256)])
    # The first state by two bytes; 256 stands for the end of the word.
    pairs = _literal(pa.array(np.array([[(ids.get(bytes([a, b]), NEVER) << BITS) + single[a] for b in range(256)] + [(NEVER << BITS) + single[a]] for a in range(256)]).ravel()))
    low, high, never, ended = F.lit(NEVER - 1), F.lit(-NEVER), F.lit(NEVER), F.lit(NEVER << BITS)
    # A token that merges with none stands at both ends.
    edge = F.array(F.lit((NEVER << BITS) + len(pieces)))
    over = F.lit((NEVER << BITS) + len(pieces) + 1)

    def fold(words: Column, shift: Column, table: Column, pairs: Column) -> Column:
        def rank(a: Column, b: Column) -> Column:
            """The rank of a pair in its bits: an entry of the table has a above its rank, which leaves the rank alone if a is right."""
            return F.shiftleft(F.least(F.get(table, F.get(shift, a) + b).bitwiseXOR(F.shiftleft(a, BITS)), never), BITS)

        def merge(s: Column, least: Column) -> Column:
            new, i = F.shiftright(least, BITS), least.bitwiseAND(low).cast("int")
            before = F.get(s, i - 1).bitwiseAND(low)
            left = rank(before, new).bitwiseOR(before)
            right = rank(new, F.get(s, i + 2).bitwiseAND(low)).bitwiseOR(new)
            return F.concat(F.slice(s, F.lit(1), i - 1), F.array(left, right), F.slice(s, i + 3, never))

        def step(s: Column, _: Column) -> Column:
            # The least rank with its index: array_position would leave its loop by an exception, which takes longer than all the rest.
            least = F.array_min(F.transform(s, lambda x, i: x.bitwiseAND(high) + i))
            done = F.concat(F.array(over), F.slice(s, F.lit(2), never))
            return F.when(F.get(s, F.lit(0)) == over, s).otherwise(_let(least, s, lambda s, least: F.when(least >= ended, done).otherwise(merge(s, least))))

        def one(word: Column) -> Column:
            start = F.transform(word, lambda b, i: F.get(pairs, b * 257 + F.coalesce(F.get(word, i + 1), F.lit(256).cast("smallint"))))
            return F.aggregate(word, F.concat(edge, start, edge), step, lambda s: F.transform(F.slice(s, F.lit(2), F.size(s) - 2), lambda x: x.bitwiseAND(low).cast("int")))

        return F.transform(words, one)

    return lambda words: _bound([shift, table, pairs], lambda *x: fold(words, *x))


@functools.lru_cache(1)
def classes() -> bytes:
    """The class of every character, compressed."""
    codes = np.arange(0x110000, dtype="<u4")
    codes[0xD800:0xE000] = 0
    every = codes.tobytes().decode("utf-32-le")
    out = np.full(0x110000, SYMBOL, np.uint8)
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(name, every):
            out[m.start() : m.end()] = kind
    return zlib.compress(out.tobytes(), 9)


def _starts(kind: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Where words begin, by PATTERN: `kind` has the classes of the characters, with an APART behind each text."""
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[0], before[1:], after[-1], after[:-1] = APART, kind[:-1], APART, kind[1:]
    blank = np.empty(len(kind), np.bool_)
    blank[0], blank[1:] = False, chars[:-1] == 32
    space = kind == SPACE
    # White space is a word but for its last character, which is a word of its own or, if a blank, begins the word that follows.
    start = space & ((before != SPACE) | ((after != SPACE) & (after != APART))) | ~space & (kind != before) & ~blank & (kind != APART)
    mark = np.flatnonzero((chars == 39) & start & (after == LETTER))
    if len(mark):
        at = lambda k: chars[np.minimum(mark + k, len(chars) - 1)]
        a, b = at(1), at(2)
        size = np.where(np.isin(a, [115, 116, 109, 100]), 1, np.where(((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108), 2, 0))
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        rest = mark + 1 + size
        start[rest[kind[rest] == LETTER]] = True
    return start


def _words(texts: list[str], table: np.ndarray, up: np.ndarray, down: np.ndarray) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one; hash, start and end in it of each word; words of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    whole = "".join(texts)
    own = np.ones(int(sizes.sum()) + len(texts), np.bool_)
    ends = np.cumsum(sizes + 1) - 1
    own[ends] = False
    chars = np.zeros(len(own), np.uint32)
    chars[own] = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kind = table[chars]
    kind[ends] = APART
    start = np.flatnonzero(_starts(kind, chars))
    text = np.searchsorted(ends, start)
    # A word ends where the next begins, or at the end of its text.
    stop = np.minimum(np.append(start[1:], len(own)), ends[text] if len(start) else start)
    hashes = np.zeros(len(start), U)
    with np.errstate(over="ignore"):
        value = mix(chars.astype(U) + U(1))
        # The powers reach as far as one chunk; a longer text is summed up in pieces that begin at a word.
        at = 0
        while at < len(start):
            to = max(at + 1, int(np.searchsorted(stop, start[at] + len(up) - 1, side="right")))
            a, b = int(start[at]), int(stop[to - 1])
            if b - a >= len(up):
                hashes[at] = _far(value[a:b])
            else:
                total = np.zeros(b - a + 1, U)
                np.cumsum(value[a:b] * up[: b - a], out=total[1:])
                hashes[at:to] = (total[stop[at:to] - a] - total[start[at:to] - a]) * down[start[at:to] - a]
            at = to
        hashes = mix(hashes + (stop - start).astype(U))
    return whole, hashes, start - text, stop - text, np.bincount(text, minlength=len(texts))


_AFTER_LETTER = regex.compile(r"(?<=\p{L})\s")


def _pieces(text: str) -> Iterator[str]:
    """A text, cut where a letter stands before white space if it is very long: there a word ends, whatever follows."""
    at = 0
    while len(text) - at > 8 * CHUNK and (m := _AFTER_LETTER.search(text, at + 4 * CHUNK)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def _far(value: np.ndarray) -> np.ndarray:
    """The sum of one word that is longer than a chunk."""
    with np.errstate(over="ignore"):
        power = np.full(len(value), P, U)
        power[0] = 1
        return (value * np.cumprod(power, dtype=U)).sum(dtype=U)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers of up to 32 bits: how many, and their bytes, each kind apart, compressed."""
    return len(values).to_bytes(4, "little") + pa.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    return np.ascontiguousarray(np.frombuffer(pa.decompress(raw[4:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n).T).view("<i4").ravel()


def _bundle(words: list[bytes]) -> bytes:
    """Words as one value."""
    body, sizes = b"".join(words), _packed(np.fromiter(map(len, words), np.int64, len(words)))
    return len(sizes).to_bytes(4, "little") + len(body).to_bytes(4, "little") + sizes + pa.compress(body, "zstd", asbytes=True)


def _unbundled(raw: bytes) -> pa.Array:
    cut, body = int.from_bytes(raw[:4], "little") + 8, int.from_bytes(raw[4:8], "little")
    at = np.concatenate([[0], np.cumsum(_unpacked(raw[8:cut]), dtype=np.int64)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(pa.decompress(raw[cut:], body, "zstd", asbytes=True))])


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values, kind))


def _one(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class _Block:
    """Documents and their distinct words, by hash."""

    def __init__(self, name: str) -> None:
        self.name = name
        self.docs: list[int | None] = []
        self.some: list[bool] = []
        self.counts: list[int] = []
        self.refs: list[np.ndarray] = []
        self.words: list[bytes] = []
        self.known, self.place, self.chars = np.zeros(0, U), np.zeros(0, np.int64), 0

    def add(self, whole: str, hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> None:
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), np.bool_)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        place = np.empty(len(distinct), np.int64)
        place[~new] = self.place[at[~new]]
        place[new] = len(self.words) + np.arange(int(new.sum()))
        self.words += [whole[a:b].encode() for a, b in zip(start[first[new]].tolist(), stop[first[new]].tolist(), strict=True)]
        self.known, self.place = np.insert(self.known, at[new], distinct[new]), np.insert(self.place, at[new], place[new])
        self.refs.append(place[which].astype(np.int32))
        self.chars += len(whole)

    def rows(self, places: int) -> pa.RecordBatch:
        refs = np.concatenate(self.refs) if self.refs else np.zeros(0, np.int32)
        often = np.bincount(refs, minlength=len(self.words))
        sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        # Frequent words get the low numbers, which are few bytes; those in windows come last.
        order = np.lexsort((-often, sizes > WINDOW))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        plain = int((sizes <= WINDOW).sum())
        asked = [self.words[i] for i in order[:plain]]
        at, windows, longer = {}, [], [self.words[i] for i in order[plain:]]
        for word in longer:
            own = []
            for a in range(0, len(word) - WINDOW // 2, WINDOW // 2):
                piece = word[a : a + WINDOW]
                if piece not in at:
                    at[piece] = len(asked)
                    asked.append(piece)
                own.append(at[piece])
            windows.append(own)
        bucket = np.fromiter((zlib.crc32(w) for w in asked), np.int64, len(asked)) % places
        coded = number[refs]
        # Part of a block's name is what it holds, so that one that was made anew from other input finds no answers.
        name = hashlib.blake2b(f"{self.name} {len(self.docs)}".encode() + coded.tobytes() + b"".join(asked), digest_size=8)
        block = int.from_bytes(name.digest(), "little") >> 1
        target = block % places
        by = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[by], prepend=-1)).tolist() + [len(by)]
        parts = [(int(bucket[by[a]]), _bundle([asked[i] for i in by[a:b].tolist()])) for a, b in zip(cuts, cuts[1:], strict=False)]
        n = len(parts)
        blank = lambda kind: pa.nulls(n, kind)
        ints = pa.list_(pa.int32())
        both = lambda kind, own: pa.concat_arrays([blank(kind), own.cast(kind)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in parts] + [target], pa.int32()), pa.array([block] * (n + 1), pa.int64()), pa.array([target] * (n + 1), pa.int32()), pa.array([w for _, w in parts] + [None], pa.binary()),
                both(pa.list_(pa.int64()), _one(pa.array(self.docs, pa.int64()))), both(pa.list_(pa.bool_()), _one(pa.array(self.some, pa.bool_()))), both(ints, _one(pa.array(self.counts, pa.int32()))),
                both(pa.binary(), pa.array([_packed(coded)], pa.binary())), both(pa.binary(), pa.array([_packed(bucket)], pa.binary())), both(pa.list_(ints), _one(pa.array(windows, ints))), both(pa.list_(pa.binary()), _one(pa.array(longer, pa.binary()))),
            ],
            ["place", "block", "target", "words", "docs", "some", "counts", "refs", "buckets", "windows", "longer"],
        )


def _cutter(places: int, limit: int):
    packed = classes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zlib.decompress(packed), np.uint8)
        powers = []
        with np.errstate(over="ignore"):
            for base in (P, P_INV):
                p = np.full(2 * CHUNK, base, U)
                p[0] = 1
                powers.append(np.cumprod(p, dtype=U))
        own, blocks = TaskContext.get(), 0
        task = own.partitionId() if own else 0
        block, held, chars = _Block(f"{task} 0"), [], 0

        def cut() -> None:
            nonlocal held, chars
            parts = [(i, p) for i, t in enumerate(held) if t for p in _pieces(t)]
            counts = np.zeros(len(held), np.int64)
            if parts:
                whole, hashes, start, stop, each = _words([p for _, p in parts], table, *powers)
                block.add(whole, hashes, start, stop)
                np.add.at(counts, [i for i, _ in parts], each)
            block.counts += counts.tolist()
            block.some += [t is not None for t in held]
            held, chars = [], 0

        for batch in batches:
            for at in range(0, len(batch), 64):
                some = batch.slice(at, 64)
                for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    block.docs.append(doc)
                    held.append(text)
                    chars += len(text or "")
                    if chars >= CHUNK:
                        cut()
                        if block.chars >= limit:
                            yield block.rows(places)
                            blocks += 1
                            block = _Block(f"{task} {blocks}")
        if held:
            cut()
        if block.docs:
            yield block.rows(places)

    return run


def _distinct(table: pa.Table) -> pa.Table:
    """The distinct words of one place, and which of them each block asks for."""
    asked = table.filter(table.column("words").is_valid())
    found = [_unbundled(raw) for raw in asked.column("words").to_pylist()]
    every = pa.concat_arrays(found).dictionary_encode() if found else pa.array([], pa.binary()).dictionary_encode()
    words = every.dictionary
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0] : at[-1]] if len(words) else np.zeros(0, np.uint8)
    one = _one(_lists(raw.astype(np.int16), np.diff(at), pa.int16()))
    bucket = asked.column("place")[0].as_py() if len(asked) else None
    return pa.table(
        {
            "words": one, "refs": pa.array([_packed(every.indices.to_numpy(zero_copy_only=False))], pa.binary()), "blocks": _one(asked.column("block").combine_chunks()), "targets": _one(asked.column("target").combine_chunks()),
            "counts": _one(pa.array([len(x) for x in found], pa.int32())), "bucket": pa.array([bucket], pa.int32()),
        }
    )


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block asked for."""
    for batch in batches:
        for i in range(len(batch)):
            column = lambda name: batch.column(name)[i].values  # noqa: B023, E731
            ids = column("ids")
            flat, sizes = ids.flatten().to_numpy(zero_copy_only=False), ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            at, counts = np.cumsum(sizes) - sizes, column("counts").to_numpy(zero_copy_only=False).astype(np.int64)
            refs = _unpacked(batch.column("refs")[i].as_py())
            flat = flat.astype(np.int32)
            out: tuple[list, list] = ([], [])
            for own in np.split(refs, np.cumsum(counts)[:-1]) if len(counts) else []:
                out[0].append(_packed(_gathered(flat, at, sizes, own)))
                out[1].append(_packed(sizes[own]))
            n = len(counts)
            yield pa.RecordBatch.from_arrays([column("targets"), column("blocks"), pa.array([batch.column("bucket")[i].as_py()] * n, pa.int32()), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], ["place", "block", "bucket", "ids", "sizes"])


def _gathered(flat: np.ndarray, at: np.ndarray, sizes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The ids of words, one after the other."""
    n = sizes[own]
    total = np.cumsum(n, dtype=np.int64)
    where = np.repeat(at[own] - (total - n), n)
    where += np.arange(len(where))
    return flat[where]


def spliced(windows: list[list[int]], sizes: list[int]) -> list[int] | None:
    """The ids of a word from those of its windows, which begin WINDOW / 2 bytes apart; None if two windows have no token in common."""
    out: list[int] = []
    begins: list[int] = []
    for k, ids in enumerate(windows):
        at = first = k * (WINDOW // 2)
        here = {}
        for j, i in enumerate(ids):
            here[at, i] = j
            at += sizes[i]
        at, j, n = first, -1, len(out) - 1
        if k:
            while n >= 0 and begins[n] >= first and (begins[n], out[n]) not in here:
                n -= 1
            if n < 0 or begins[n] < first:
                return None
            j, at = here[begins[n], out[n]], begins[n] + sizes[out[n]]
            del out[n + 1 :], begins[n + 1 :]
        for i in ids[j + 1 :]:
            out.append(i)
            begins.append(at)
            at += sizes[i]
    return out


def _assembler(pieces: tuple[bytes, ...]):
    sizes_of = np.array([len(p) for p in pieces], np.uint16)
    joined = zlib.compress(b"".join(pieces), 6)

    def run(parts: pa.Table, answers: pa.Table) -> pa.Table:
        by: dict[int, list[tuple[int, bytes, bytes]]] = {}
        for block, *rest in zip(*(answers.column(c).to_pylist() for c in ("block", "bucket", "ids", "sizes")), strict=True):
            by.setdefault(block, []).append(tuple(rest))
        length = sizes_of.tolist()
        ids: dict[bytes, int] = {}
        docs, lists = [], []
        own = parts.filter(parts.column("docs").is_valid())
        for i in range(len(own)):
            column = lambda name: own.column(name)[i].values  # noqa: B023, E731
            counts = column("counts").to_numpy(zero_copy_only=False).astype(np.int64)
            windows, longer = column("windows").to_pylist(), column("longer").to_pylist()
            found = sorted(by.get(own.column("block")[i].as_py(), []))
            asked, flat = [_unpacked(s) for _, _, s in found], [_unpacked(x) for _, x, _ in found]
            buckets = _unpacked(own.column("buckets")[i].as_py())
            if len(buckets) != sum(map(len, asked)) or not np.array_equal(np.unique(buckets), [b for b, _, _ in found]):
                raise RuntimeError("a block has lost words: its input isn't the same as when they were asked for")
            # Answers come by bucket, in the order of the block's words.
            place = np.argsort(buckets, kind="stable")
            sizes, at = np.zeros(len(buckets) + len(longer), np.int64), np.zeros(len(buckets) + len(longer), np.int64)
            got = np.concatenate(asked) if asked else np.zeros(0, np.int64)
            sizes[place], at[place] = got, np.cumsum(got) - got
            every = np.concatenate(flat) if flat else np.zeros(0, np.int64)
            plain = len(sizes) - len(longer) - len({w for x in windows for w in x})
            more, size = [], len(every)
            # Words in windows come behind the plain ones, where the windows stand meanwhile.
            to, start = np.zeros(plain + len(longer), np.int64), np.zeros(plain + len(longer), np.int64)
            to[:plain], start[:plain] = sizes[:plain], at[:plain]
            for k, (word, own_windows) in enumerate(zip(longer, windows, strict=True), plain):
                one = spliced([every[at[w] : at[w] + sizes[w]].tolist() for w in own_windows], length)
                if one is None:
                    if not ids:
                        cuts, raw = np.concatenate([[0], np.cumsum(sizes_of.astype(np.int64))]).tolist(), zlib.decompress(joined)
                        ids = {raw[a:b]: j for j, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))}
                    one = heap_merged(word, ids)
                more.append(one)
                to[k], start[k] = len(one), size
                size += len(one)
            if more:
                every = np.concatenate([every, *more])
            refs = _unpacked(own.column("refs")[i].as_py())
            some, every, ends = column("some").to_numpy(zero_copy_only=False), every.astype(np.int32), np.cumsum(counts)
            docs.append(column("docs"))
            # Some documents at a time, so that few places are gathered at once.
            first = 0
            while first < len(counts):
                stop = max(first + 1, int(np.searchsorted(ends, ends[first] - counts[first] + (1 << 19), side="right")))
                mine = refs[ends[first] - counts[first] : ends[stop - 1]]
                total = np.concatenate([[0], np.cumsum(to[mine])])
                cuts = pa.array(total[np.concatenate([[0], np.cumsum(counts[first:stop])])].astype(np.int32))
                lists.append(pa.ListArray.from_arrays(cuts, pa.array(_gathered(every, start, to, mine)), mask=pa.array(~some[first:stop])))
                first = stop
        return pa.table({"doc_id": pa.chunked_array(docs, pa.int64()), "ids": pa.chunked_array(lists, pa.list_(pa.int32()))})

    return run


def _places(docs: DataFrame) -> int:
    """Groups of words and blocks: the session's shuffle partitions, or more where files that are known to be large are read."""
    leaves = docs._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()) if leaves.apply(i).getClass().getSimpleName() == "LogicalRelation"]
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(sum(sizes) / PLACE_BYTES))


def encoded(docs: DataFrame, path: str = VOCABULARY, block: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and ids (the tokens of the text) for every row of `docs`.

    An empty text has no ids, a null text null ids; rows are encoded one by one, so repeated rows and null doc_ids give a row each.
    Texts and words may have any length.  Of pairs of equal rank the leftmost merges first.  Strings that name special tokens are
    ordinary text.  Other columns are ignored.  Within a block words are told apart by hashes of 64 bits.
    """
    pieces, places = vocabulary(path), _places(docs)
    text = modest(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = text.mapInArrow(tidy(_cutter(places, block)), PART).repartition(places, "place")
    words = parts.groupBy("place").applyInArrow(tidy_group(_distinct), DISTINCT)
    ids = words.select(merged(pieces)(F.col("words")).alias("ids"), "refs", "blocks", "targets", "counts", "bucket")
    answers = ids.mapInArrow(tidy(_answers), ANSWER)
    return parts.groupBy("place").cogroup(answers.groupBy("place")).applyInArrow(tidy_groups(_assembler(pieces)), ENCODED)


def decoded(ids: Column, path: str = VOCABULARY) -> Column:
    """The bytes that a column of token ids stands for: null for null ids, or where an id is null or none of the vocabulary's."""
    pieces = _literal(pa.array([p.hex() for p in vocabulary(path)], pa.string()))
    # A piece that is missing leaves a sign that is no hexadecimal digit, for which unhex gives null.
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "", "?"))


def round_trip(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, ids, n_tokens and text (decoded from the ids) for every row of `docs`; see `encoded`."""
    ids = encoded(docs, path)
    return ids.select("doc_id", "ids", F.size("ids").alias("n_tokens"), decoded(F.col("ids"), path).cast("string").alias("text"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`round_trip` of all documents."""
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
