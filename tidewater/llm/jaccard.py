"""N-gram Jaccard join by parity sketches.

Each document is the set of its word n-grams.  A parity sketch of a set is a bit vector in which every member toggles one bit, so
the XOR of two sketches is the sketch of the symmetric difference, and their Hamming distance never exceeds the size of that
difference.  Jaccard >= t allows a symmetric difference of at most (1 - t) / (1 + t) of the summed sizes, and sizes that differ by
a factor of at most t: sets are banded by size and only sets of one band meet.

Within a band the sketch is wide (a place for each of 2^58 values in each segment) and sparse; a non-empty segment is represented by
the XOR of one random word for each member, so equal segments have equal words.  Two sets whose difference is at most D touch at most
D of each other's segments.  All sets order their segments alike, telling ones first (by how few documents have each member), and the
D + 1 first are joined on equality: by the pigeonhole the first untouched segment of a pair is among them on both sides, so no
pair is missed.  A pair is put down where its first common segment is, unless the sizes forbid it or BITS one-bit minwise hashes of
both agree so seldom that a pair at the threshold would do so once in ten million; the rest are verified on their whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import modest, settled, sized, tidy, tidy_groups, without_ids
from tidewater.llm.hashing import U, mix, ngrams, word_hashes

NGRAM = 2
THRESHOLD = 0.7
#: Sets of the bands below EACH members have a segment for each value; in others the smallest set has PER segments for each member, more
#: below FEW members.  So many hold something in any set of the band that D or fewer would be five standard deviations from the mean.
EACH = 16
FEW = 128
PER = (2.0, 1.0)
#: Counters of documents by n-gram, which order the segments.
SLOTS = 1 << 16
#: Segments of one band in one group of the join on average, and documents that may share one before they are split into tiles.
BUCKET_KEYS = 2_000_000
TILE_DOCS = 200_000
#: Segments that a task packs at a time, and of those that meet in a bucket, how many are sorted and paired at a time; pairs at a time, and sets
#: that a task remembers to send each once.  They bound a worker's memory and change no result.
PACK_KEYS = 400_000
MEET_KEYS = 250_000
MEET_PAIRS = 1 << 17
SEEN_SETS = 1 << 16
#: First segments of each set that tell whether a pair has met before.
FIRST = 2
#: Minwise hashes of a set of which one bit each is kept.
BITS = 128
FACTORS = mix(np.arange(1, BITS + 1).astype(U) * U(0x9E3779B97F4A7C15)) | U(1)
#: Verification: bytes of sets in one group, pairs of one segment before its documents are split into tiles.
GROUP_BYTES = 10 << 20
TILE_PAIRS = 250_000

SIGNATURE = "doc_id long, n int, sid long, slots array<int>"
PACKED = "bucket int, codes binary, own binary, sids binary, spaces binary, firsts binary, sizes binary, bits binary"
LOW = U(0xFFFFFFFF)


def least(b: int, t: float) -> int:
    """Members of the smallest set of a band; bands grow by 1/t, so a pair within the size ratio t lies in one band or in two neighbours."""
    return math.ceil((1 / t) ** b - 1e-9)


def spaces(n: int, t: float) -> list[tuple[int, int]]:
    """The bands in which a set of n members meets others, its own and that below, each with the greatest difference from any of them."""
    b = max(0, int(math.log(n) / -math.log(t)) - 1)
    while least(b + 1, t) <= n:
        b += 1
    share = (1 - t) / (1 + t)
    out = [(b, int(share * (n + n / t) + 1e-9))]
    below = least(b, t) - 1
    if b and n * t <= below + 1e-9:
        out.append((b - 1, int(share * (n + below) + 1e-9)))
    return out


def keys(grams: np.ndarray, t: float, weights: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each band of a set: the band, the words of its D + 1 most telling segments, and how many documents have their rarest member."""
    out = []
    often = weights[(grams >> U(48)).astype(np.int64)]
    common = np.log((often + 1) / (weights.sum() + 1))
    for space, most in spaces(len(grams), t):
        low = least(space, t)
        if low < EACH:
            words, rare, order = mix(grams ^ U(0x5851F42D4C957F2D) + U(space)), often, common
        else:
            at = (grams >> U(16)) % U(round(PER[low >= FEW] * low))
            order = np.argsort(at, kind="stable")
            at = at[order]
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            words = mix(np.bitwise_xor.reduceat(mix(grams[order] ^ U(0x5851F42D4C957F2D)), first) + mix(at[first] + U(space << 40)))
            rare, order = np.minimum.reduceat(often[order], first), np.add.reduceat(common[order], first)
        some = np.lexsort((words, order))[: most + 1]
        out.append((space, words[some], rare[some]))
    return out


def minwise(grams: np.ndarray) -> np.ndarray:
    """One bit of each of BITS minwise hashes, as bytes."""
    low = np.full(BITS, ~U(0))
    for at in range(0, len(grams), 1024):
        low = np.minimum(low, (grams[at : at + 1024, None] * FACTORS).min(axis=0))
    return np.packbits((mix(low) >> U(63)).astype(np.uint8))


def agreement(t: float) -> int:
    """Bits of BITS that agree at least, but for one in ten million pairs, where the coefficient is t or more: each does with a chance of (1 + t) / 2."""
    p, tail = (1 + t) / 2, 0.0
    for k in range(BITS + 1):
        tail += math.comb(BITS, k) * p**k * (1 - p) ** (BITS - k)
        if tail > 1e-7:
            return k
    return BITS


def set_id(grams: np.ndarray) -> np.ndarray:
    """64 bits that stand for a set."""
    one = mix(np.bitwise_xor.reduce(mix(grams ^ U(0x2545F4914F6CDD1D))) + U(len(grams)))
    return mix(one + mix(grams.sum(dtype=U)))


def _grams(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for start, end, hashes, at in word_hashes(batch.column("text")):
        for i in range(end - start):
            if at[i + 1] > at[i]:
                yield start + i, ngrams(hashes[at[i] : at[i + 1]], n)


def _grams(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for start, end, hashes, at in word_hashes(batch.column("text")):
        for i in range(end - start):
            if at[i + 1] > at[i]:
                yield start + i, ngrams(hashes[at[i] : at[i + 1]], n)


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.zeros(SLOTS, np.int64)
        names = ["doc_id", "n", "sid", "slots"]
        for batch in batches:
            rows, sizes, sids = [], [], []
            with np.errstate(over="ignore"):
                for row, grams in _grams(batch, n):
                    rows.append(row)
                    sizes.append(len(grams))
                    sids.append(set_id(grams))
                    # Sorted as they are, their first bits are sorted, too.
                    slot = (grams >> U(48)).astype(np.int64)
                    often[slot[np.flatnonzero(np.diff(slot, prepend=-1))]] += 1
            none = np.ones(len(batch), np.bool_)
            none[rows] = False
            order = np.argsort(np.concatenate([rows, np.flatnonzero(none)]).astype(np.int64), kind="stable")
            blank = int(none.sum())
            own = [pa.array(sizes, pa.int32()), pa.array(np.array(sids, U).view(np.int64))]
            own = [pa.concat_arrays([x, pa.nulls(blank, x.type)]).take(pa.array(order)) for x in own]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *own, pa.nulls(len(batch), pa.list_(pa.int32()))], names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.array([np.minimum(often, 1 << 30)], pa.list_(pa.int32()))], names)

    return run


def _bytes(values: np.ndarray) -> bytes:
    """Whole numbers of 64 bits: how many, and their bytes, each kind apart, compressed."""
    return len(values).to_bytes(4, "little") + pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _values(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    return np.ascontiguousarray(np.frombuffer(pa.decompress(raw[4:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n).T).view(U).ravel()


def lanes(bands: list[tuple[int, int]], t: float, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many buckets each band's segments go to, and the first of them, from (band, members of its sets).  Only sets of a band meet,
    so a set's segments go to as few buckets as the size of its band asks for."""
    total = np.zeros(max((b for b, _ in bands), default=0) + 3)
    for b, members in bands:
        # The band may be one off, as it comes from a logarithm.
        for k, share in ((b, (1 - t) / t), (b - 1, 2 * (1 - t) / (1 + t))):
            if k >= 0:
                total[k] += share * members
    many = np.maximum(1, np.ceil(total / size)).astype(np.int64)
    return many, np.cumsum(many) - many


def _packer(n: int, t: float, weights: np.ndarray, many_buckets: np.ndarray, first_bucket: np.ndarray, tile: int, limit: int = PACK_KEYS):
    """The segments of some documents at a time, by the bucket in which they meet others; about `limit` segments, however long the documents are."""

    # What a counter has from chance is no reason to split.
    noise = 2 * int(weights.mean())

    def pack(sids: list, where: list, firsts: list, sizes: list, bits: list, words: list, tiles: list) -> pa.RecordBatch:
        with np.errstate(over="ignore"):
            sid, space, first, size, bit = np.array(sids, U), np.array(where, np.uint8), np.stack(firsts), np.array(sizes, np.int32), np.stack(bits)
            who = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words])
            key, many = np.concatenate(words), np.concatenate(tiles)
            words.clear(), tiles.clear()
            r = (sid[who] % many.astype(U)).astype(np.uint8)
            # A segment that very many share goes to a tile for each other part of its documents.
            if many.max() > 1:
                again = np.repeat(np.arange(len(key)), many)
                other = (np.arange(len(again)) - np.repeat(np.cumsum(many, dtype=np.int64) - many, many)).astype(np.uint8)
                key, who, many, r = key[again], who[again], many[again], r[again]
                del again
            else:
                other = r
            low, high = np.minimum(r, other).astype(U), np.maximum(r, other).astype(U)
            # Half of a word is enough within a bucket: the few that are alike by chance are told apart by what is checked later.
            code = (key & LOW) << U(32) | many.astype(U) << U(16) | low << U(8) | high
            band = np.minimum(space[who], len(many_buckets) - 1)
            bucket = (first_bucket[band] + (mix((key >> U(40)) + (low << U(8) | high) * U(0x9FB21C651E98DF25)) % many_buckets[band].astype(U)).astype(np.int64)).astype(np.int32)
            del key, many, r, other, low, high, band
            order = np.lexsort((code, bucket))
            bucket, code, who = bucket[order], code[order], who[order]
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
            out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
            for a, b in zip(cuts, cuts[1:], strict=False):
                some, which = np.unique(who[a:b], return_inverse=True)
                which = pa.compress(which.astype(np.uint16 if len(some) < 65536 else np.uint32).tobytes(), "zstd", asbytes=True)
                for column, value in zip(out, (int(bucket[a]), _bytes(np.diff(code[a:b], prepend=U(0))), which, sid[some].tobytes(), space[some].tobytes(), first[some].tobytes(), size[some].tobytes(), bit[some].tobytes()), strict=True):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:])], ["bucket", "codes", "own", "sids", "spaces", "firsts", "sizes", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, ...] = ([], [], [], [], [], [], [])
        seen: set[int] = set()
        segments = 0
        for batch in batches:
            for _, grams in _grams(batch, n):
                with np.errstate(over="ignore"):
                    sid = set_id(grams)
                    # Equal sets have equal segments: one of each that a task has met lately is enough.
                    if int(sid) in seen:
                        continue
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(int(sid))
                    bit = minwise(grams)
                    for space, key, rare in keys(grams, t, weights):
                        head = np.zeros(FIRST, np.uint32)
                        head[: len(key[:FIRST])] = key[:FIRST] & LOW
                        many = np.clip((rare.astype(np.int64) - noise) // tile + 1, 1, 255).astype(np.uint8)
                        for column, value in zip(held, (sid, space, head, len(grams), bit, key, many), strict=True):
                            column.append(value)
                        segments += len(key)
                if segments >= limit:
                    yield pack(*held)
                    held, segments = ([], [], [], [], [], [], []), 0
        if held[0]:
            yield pack(*held)

    return run


def _runs(code: np.ndarray, own: np.ndarray, step: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Segment, and both sets, of all pairs that share a segment, some at a time; `code` is sorted."""
    start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    size = np.diff(np.append(start, len(code)))
    for n in np.unique(size[size > 1]).tolist():
        these = start[size == n]
        if n <= 64:
            i, j = np.triu_indices(n, 1)
            for at in range(0, len(these), max(1, step // len(i))):
                some = these[at : at + max(1, step // len(i))]
                yield np.repeat(code[some], len(i)), own[some[:, None] + i].ravel(), own[some[:, None] + j].ravel()
        else:
            for a in these.tolist():
                for i in range(a, a + n - 1, max(1, step // n)):
                    x = np.arange(i, min(i + max(1, step // n), a + n - 1))
                    many = a + n - 1 - x
                    left = np.repeat(x, many)
                    right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + left + 1
                    yield np.full(len(left), code[a]), own[left], own[right]


def _meet(t: float, limit: int = MEET_KEYS):
    least_agreement = agreement(t)
    met = pa.schema([("sid_a", pa.int64()), ("sid_b", pa.int64()), ("n_a", pa.int32()), ("n_b", pa.int32()), ("word", pa.int64())])

    def rows(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64), kind) for i, kind in enumerate(met.types)], schema=met)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of sets within the size ratio whose first common segment is in this bucket; of the segments, which are hashes, a range at a time."""
        codes, owns, bases, tables, before = [], [], [], ([], [], [], []), 0
        for batch in batches:
            for c, o, s, f, m, w in zip(*(batch.column(x) for x in ("codes", "own", "sids", "firsts", "sizes", "bits")), strict=True):
                with np.errstate(over="ignore"):
                    code = np.cumsum(_values(c.as_py()), dtype=U)
                for column, value, kind in zip(tables, (s, f, m, w), (U, np.uint32, np.int32, U), strict=True):
                    column.append(np.frombuffer(value.as_py(), kind))
                kind = np.uint16 if len(tables[0][-1]) < 65536 else np.uint32
                codes.append(code), owns.append(np.frombuffer(pa.decompress(o.as_py(), len(code) * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)), bases.append(before)
                before += len(tables[0][-1])
            del batch
        joined = []
        for column in tables:
            joined.append(np.concatenate(column) if column else np.zeros(0, U))
            column.clear()
        sid, first, size, bit = joined[0], joined[1].reshape(-1, FIRST), joined[2], joined[3].reshape(-1, BITS // 64)
        passes = max(1, math.ceil(sum(map(len, codes)) / limit))
        edges = np.array([(i << 64) // passes for i in range(1, passes)], U)
        cuts = [[0, *np.searchsorted(c, edges).tolist(), len(c)] for c in codes]
        found: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        for i in range(passes if codes else 0):
            code = np.concatenate([c[x[i] : x[i + 1]] for c, x in zip(codes, cuts, strict=True)])
            own = np.concatenate([o[x[i] : x[i + 1]].astype(np.int32) + np.int32(b) for o, x, b in zip(owns, cuts, bases, strict=True)])
            order = np.lexsort((sid[own], code))
            code, own = code[order], own[order]
            # Equal sets are one.
            keep = np.ones(len(code), np.bool_)
            keep[1:] = (code[1:] != code[:-1]) | (sid[own[1:]] != sid[own[:-1]])
            code, own = code[keep], own[keep]
            for k, a, b in _runs(code, own, MEET_PAIRS):
                fit = (size[a] >= t * size[b] - 1e-9) & (size[b] >= t * size[a] - 1e-9)
                k, a, b = k[fit], a[fit], b[fit]
                fit = np.bitwise_count(bit[a] ^ bit[b]).sum(axis=1) <= BITS - least_agreement
                k, a, b = k[fit], a[fit], b[fit]
                tiles = (k >> U(16)) & U(255)
                fit = (tiles == U(1)) | ((k >> U(8)) & U(255) == k & U(255)) | (sid[a] % tiles != sid[b] % tiles)
                low = (k >> U(32)).astype(np.uint32)
                x, y = first[a], first[b]
                for p in range(FIRST):
                    # A segment of both that comes before this one.
                    ahead_x = ~(x[:, : p + 1] == low[:, None]).any(axis=1) & (x[:, p] != 0)
                    for q in range(FIRST):
                        fit &= ~(ahead_x & (x[:, p] == y[:, q]) & ~(y[:, : q + 1] == low[:, None]).any(axis=1))
                k, a, b = k[fit], a[fit], b[fit]
                swap = sid[a].view(np.int64) > sid[b].view(np.int64)
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                if len(k):
                    found.append((sid[a].view(np.int64), sid[b].view(np.int64), size[a], size[b], k.view(np.int64)))
                    waiting += len(k)
                if waiting >= MEET_PAIRS:
                    yield rows(found)
                    found, waiting = [], 0
        yield rows(found)

    return run


def _body(grams: np.ndarray, text: pa.Buffer) -> bytes:
    """A set on its way: its text, compressed, where that is shorter than the set and takes at most twice its memory."""
    if text.size <= 16 * len(grams):
        short = text.size.to_bytes(4, "little") + pa.compress(text, "zstd", asbytes=True)
        if len(short) < 8 * len(grams):
            return b"t" + short
    return b"s" + grams.tobytes()


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sets are larger than their texts, so they go out some rows at a time.
        for batch in (b.slice(at, 512) for b in batches for at in range(0, len(b), 512)):
            sids, bodies = [], []
            with np.errstate(over="ignore"):
                for row, grams in _grams(batch, n):
                    sids.append(set_id(grams))
                    bodies.append(_body(grams, batch.column("text")[row].as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(sids, U).view(np.int64)), pa.array(bodies, pa.binary())], ["sid", "body"])

    return run


def _unpacked(bodies: pa.ChunkedArray, n: int) -> list[np.ndarray]:
    """The sets that `_body` packed."""
    out: list[np.ndarray] = []
    for at in range(0, len(bodies), 128):
        some = [b.as_py() for b in bodies.slice(at, 128)]
        texts = pa.array([pa.decompress(b[5:], int.from_bytes(b[1:5], "little"), "zstd", asbytes=True) if b[:1] == b"t" else None for b in some], pa.binary())
        with np.errstate(over="ignore"):
            known = dict(_grams(pa.RecordBatch.from_arrays([texts], ["text"]), n))
        out += [known[i] if b[:1] == b"t" else np.frombuffer(b[1:], U) for i, b in enumerate(some)]
    return out


def _verify(n: int, t: float):
    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        sids, at = np.unique(sets.column("sid").to_numpy(), return_index=True)
        grams, ends = _unpacked(sets.column("body").take(pa.array(at)), n), [pairs.column(x).to_numpy() for x in ("sid_a", "sid_b")]
        places = [np.minimum(np.searchsorted(sids, x), len(sids) - 1) for x in ends]
        if len(pairs) and (not len(sids) or any((sids[place] != x).any() for place, x in zip(places, ends, strict=True))):
            raise KeyError("a pair has come without one of its sets")
        shared, jaccard = np.zeros(len(pairs), np.int64), np.zeros(len(pairs))
        for k in range(len(pairs)):
            p, q = grams[places[0][k]], grams[places[1][k]]
            if len(p) > len(q):
                p, q = q, p
            where = np.searchsorted(q, p)
            where[where == len(q)] = 0
            shared[k] = same = int(np.count_nonzero(q[where] == p))
            jaccard[k] = same / (len(p) + len(q) - same)
        near = jaccard >= t
        return pa.table({"sid_a": pa.array(ends[0][near]), "sid_b": pa.array(ends[1][near]), "jaccard": pa.array(jaccard[near]), "shared": pa.array(shared[near])})

    return run


def set_pairs(docs: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD, bucket: int = BUCKET_KEYS, tile: int = TILE_DOCS) -> tuple[DataFrame, DataFrame]:
    """Versions (doc_id, sid, n), one for each distinct doc_id and set, sid null without n-grams; and pairs of different sets (sid_a, sid_b, jaccard, shared)."""
    spark = docs.sparkSession
    text = modest(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text")).where("doc_id is not null")
    signs = settled(text.mapInArrow(tidy(_signatures(ngram)), SIGNATURE))
    weights = np.zeros(SLOTS, np.int64)
    for slot, often in signs.where("slots is not null").select(F.posexplode("slots")).where("col > 0").groupBy("pos").agg(F.sum("col")).collect():
        weights[slot] = often
    versions = signs.where("doc_id is not null").select("doc_id", "sid", "n").distinct()
    band = F.floor(F.log("n") / -math.log(threshold) + 1e-9).cast("int")
    bands = [tuple(b) for b in signs.where("n > 0").groupBy(band.alias("band")).agg(F.sum(F.col("n").cast("long"))).collect()]
    many, first = lanes(bands, threshold, bucket)
    packed = text.where("text is not null").mapInArrow(tidy(_packer(ngram, threshold, weights, many, first, tile)), PACKED)
    met = packed.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(many.sum())), "bucket").groupBy("bucket").applyInArrow(tidy(_meet(threshold)), "sid_a long, sid_b long, n_a int, n_b int, word long")
    near = settled(met.groupBy("sid_a", "sid_b", "n_a", "n_b").agg(F.min("word").alias("word")))

    # Pairs go where one segment sends them, in tiles if there are very many; sets follow.
    tiles = near.groupBy("word").agg(F.ceil(F.sqrt(F.count(F.lit(1)) / F.lit(float(TILE_PAIRS)))).cast("int").alias("tiles"))
    near = near.join(tiles, "word").withColumn("place", F.when(F.col("tiles") == 1, F.xxhash64("word")).otherwise(F.xxhash64("word", F.pmod(F.xxhash64("sid_a"), "tiles"), F.pmod(F.xxhash64("sid_b"), "tiles"))))
    near = settled(near.select("sid_a", "sid_b", "n_a", "n_b", "place"))
    ends = F.explode(F.array(F.struct(F.col("sid_a").alias("sid"), F.col("n_a").alias("n")), F.struct(F.col("sid_b").alias("sid"), F.col("n_b").alias("n")))).alias("d")
    routes = settled(near.select(ends, "place").select("d.sid", "d.n", "place").distinct())
    size = routes.agg(F.sum(F.col("n") * 8.0)).first()[0] or 0.0
    groups = max(1, math.ceil(size / GROUP_BYTES), spark.sparkContext.defaultParallelism)
    cut = F.pmod(F.col("place"), F.lit(groups)).cast("int").alias("cut")
    # The text of one document stands for each set.
    one = versions.join(sized(routes.select("sid").distinct(), 16), "sid", "left_semi").groupBy("sid").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    one, routes = settled(one), routes.select("sid", cut).distinct()
    sets = text.join(sized(one, 16), "doc_id", "left_semi").mapInArrow(tidy(_sets(ngram)), "sid long, body binary")
    routed = sets.join(sized(routes, 24), "sid")
    checked = near.select("sid_a", "sid_b", cut).groupBy("cut").cogroup(routed.groupBy("cut")).applyInArrow(tidy_groups(_verify(ngram, threshold)), "sid_a long, sid_b long, jaccard double, shared long")
    return versions, settled(checked)


def jaccard_join(docs: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs doc_a < doc_b, jaccard and shared (how many n-grams they have in common) that link all documents of a coefficient of at least `threshold`.

    Each set of n-grams is represented by the lowest doc_id that has it: representatives are paired with those of other sets, and every
    other document with the representative of its own set.  See `linked` for what counts as a set.
    """
    versions, pairs = set_pairs(docs, ngram, threshold)
    heads = settled(versions.where("sid is not null").groupBy("sid", "n").agg(F.min("doc_id").alias("rep")))
    for end in "ab":
        pairs = pairs.join(heads.select(F.col("sid").alias(f"sid_{end}"), F.col("rep").alias(f"rep_{end}")), f"sid_{end}")
    near = pairs.where("rep_a <> rep_b").select(F.least("rep_a", "rep_b").alias("doc_a"), F.greatest("rep_a", "rep_b").alias("doc_b"), "jaccard", "shared")
    same = versions.join(heads, ["sid", "n"]).where("doc_id <> rep")
    return near.unionByName(same.select(F.col("rep").alias("doc_a"), F.col("doc_id").alias("doc_b"), F.lit(1.0).alias("jaccard"), F.col("n").cast("long").alias("shared")))


def linked(docs: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id and links for every document: the lowest doc_id that links connect it to, and how many others it is linked with.

    Two documents are linked if their sets of word n-grams have a Jaccard coefficient of at least `threshold`.  Words are runs of ASCII
    letters and digits and of characters beyond ASCII, in lower case; a text of fewer words than n is one n-gram.  A null text, or one
    without words, has no n-grams: it is a class of its own with no links.  Texts may have any length.  Rows alike in doc_id and set are
    one document; rows that share a doc_id but differ in their sets are versions, each of which gives a row and counts by itself.  Rows
    with a null doc_id are left out, other columns ignored.  No pair is missed, unless a set's members fall into fewer segments than chance
    allows in a million sets; XX
    """
    versions, pairs = set_pairs(docs, ngram, threshold)
    sets = settled(versions.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    both = pairs.select(F.col("sid_a").alias("sid"), F.col("sid_b").alias("other")).unionByName(pairs.select(F.col("sid_b").alias("sid"), F.col("sid_a").alias("other")))
    far = both.join(sets.select(F.col("sid").alias("other"), "copies"), "other").groupBy("sid").agg(F.sum("copies").alias("far"))
    heads = components(pairs.select(F.col("sid_a").alias("doc_a"), F.col("sid_b").alias("doc_b"))).select(F.col("doc_id").alias("sid"), "head")
    sets = settled(sets.join(far, "sid", "left").join(heads, "sid", "left").withColumn("head", F.coalesce("head", "sid")))
    classes = sets.groupBy("head").agg(F.min("rep").alias("class_id"))
    known = sets.join(classes, "head").select("sid", "class_id", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("links"))
    rows = versions.select("doc_id", "sid").join(known, "sid", "left")
    return rows.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def components(pairs: DataFrame) -> DataFrame:
    """doc_id and the lowest doc_id that pairs connect it to, for every document in a pair (large and small stars in turn)."""
    edges = settled(pairs.select(F.greatest("doc_a", "doc_b").alias("u"), F.least("doc_a", "doc_b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        edges = settled(small)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("head")).unionByName(edges.select(F.col("v").alias("doc_id"), F.col("v").alias("head")).distinct())
        before = now


def near_duplicates_removed(docs: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` less every document that links connect to one of a lower doc_id, see `linked`; columns as they came.

    All rows of a doc_id stay or go together: they go if any version of it is in a class with a lower doc_id.  Rows with a null
    doc_id stay, as do texts without words."""
    return without_ids(docs, linked(docs, ngram, threshold).where("doc_id <> class_id"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`linked` over all documents."""
    return linked(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '(?:[a-z0-9]|[^\\x00-\\x7F])+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
grams AS (
  SELECT DISTINCT doc_id, w, unnest(CASE WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g
  FROM words WHERE len(w) > 0),
versions AS (
  SELECT doc_id, gs, row_number() OVER (ORDER BY doc_id, gs) AS v, len(gs) AS n
  FROM (SELECT DISTINCT doc_id, gs FROM (SELECT doc_id, w, list(g ORDER BY g) AS gs FROM grams GROUP BY doc_id, w))),
own AS (SELECT v, n, unnest(gs) AS g FROM versions),
pairs AS (
  SELECT a.v AS a, b.v AS b FROM own a JOIN own b ON a.g = b.g AND a.v <> b.v AND a.n >= 0.7 * b.n AND b.n >= 0.7 * a.n
  GROUP BY a.v, b.v HAVING CAST(count(*) AS DOUBLE) / (max(a.n) + max(b.n) - count(*)) >= 0.7),
reach AS (SELECT v, v AS x FROM versions UNION SELECT r.v, p.b FROM reach r JOIN pairs p ON r.x = p.a),
classes AS (SELECT r.v, min(o.doc_id) AS class_id FROM reach r JOIN versions o ON o.v = r.x GROUP BY r.v)
SELECT v.doc_id, c.class_id, coalesce(k.links, 0) AS links
FROM versions v JOIN classes c ON c.v = v.v LEFT JOIN (SELECT a, count(*) AS links FROM pairs GROUP BY a) k ON k.a = v.v
UNION ALL SELECT DISTINCT d.doc_id, d.doc_id, CAST(0 AS BIGINT) FROM documents d
WHERE d.doc_id IS NOT NULL AND (d.text IS NULL OR len(regexp_extract_all(lower(d.text), '(?:[a-z0-9]|[^\\x00-\\x7F])+')) = 0)
"""
