"""Exact dedup by minimal perfect hashes over the distinct digests of a history.

The history (an earlier corpus, or the corpus itself) is reduced to its distinct SHA-256 digests, each with the lowest doc_id that
has it.  They are split by hash into shards; for each shard a task builds a minimal perfect hash: a cascade of bit levels in which
every key owns one bit, the rank of the bit being its slot.  Slots hold the full digest and the locator of the winner.  A document's
digest is sent to its shard, hashed to a slot, and compared there byte by byte, because a minimal perfect hash gives some slot for a
stranger too.  A match is a repeat of the slot's winner; digests that are no members are grouped among themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import checkpointed, fresh, sized, without_ids
from tidewater.llm.hashing import U, mix

#: Digests in one shard, on average, and rows that are looked up in one group before a shard's index is copied to several.
SHARD_KEYS = 250_000
GROUP_ROWS = 2_000_000
#: Bits a key at each level, and levels before the few keys that are left get slots in order.
GAMMA = 2.0
LEVELS = 48

INDEX = "shard int, n long, sizes array<long>, bits binary, digests binary, winners binary"


def _key(digests: np.ndarray) -> np.ndarray:
    """One 64-bit key from the four words of each digest."""
    k = digests[:, 0]
    for i in range(1, 4):
        k = mix(k) ^ digests[:, i]
    return mix(k)


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    """Digests of 32 bytes as rows of four words."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, U).reshape(-1, 4)


def build(digests: np.ndarray, winners: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Level sizes, all levels' bits, and digests and winners in the order of their slots.  The digests must be distinct."""
    with np.errstate(over="ignore"):
        keys = _key(digests)
        left = np.arange(len(keys))
        sizes, bits, order = [], [], []
        for level in range(LEVELS):
            if not len(left):
                break
            m = max(64, math.ceil(GAMMA * len(left) / 64) * 64)
            at = (mix(keys[left] + U(level) * U(0x9E3779B97F4A7C15)) % U(m)).astype(np.int64)
            one = np.bincount(at, minlength=m) == 1
            own = one[at]
            order.append(left[own][np.argsort(at[own])])
            sizes.append(m)
            bits.append(one)
            left = left[~own]
        order.append(left)
        slots = np.concatenate(order) if order else left
        return sizes, np.packbits(np.concatenate(bits)) if bits else np.zeros(0, np.uint8), digests[slots], winners[slots]


def lookup(sizes: list[int], bits: np.ndarray, slots: np.ndarray, winners: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The winner of each digest that is asked for, -1 for one that is no member.  `winners` are positions or ids of at least 0."""
    out = np.full(len(asked), -1, np.int64)
    if not len(slots) or not len(asked):
        return out
    with np.errstate(over="ignore"):
        flat = np.unpackbits(bits).view(np.bool_)
        rank = np.concatenate([[0], np.cumsum(flat)])
        keys, left, base = _key(asked), np.arange(len(asked)), 0
        for level, m in enumerate(sizes):
            at = (mix(keys[left] + U(level) * U(0x9E3779B97F4A7C15)) % U(m)).astype(np.int64) + base
            hit = flat[at]
            slot, who = rank[at[hit]], left[hit]
            same = (slots[slot] == asked[who]).all(axis=1)
            out[who[same]] = winners[slot[same]]
            left = left[~hit]
            base += m
        rest = slots[rank[-1] :]
        for i, s in enumerate(rest):
            out[left[(asked[left] == s).all(axis=1)]] = winners[rank[-1] + i]
    return out


def _build(table: pa.Table) -> pa.Table:
    winners = table.column("winner").to_numpy()
    sizes, bits, digests, winners = build(_digests(table.column("digest")), winners)
    return pa.table(
        {
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "n": pa.array([len(winners)], pa.int64()), "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "bits": pa.array([bits.tobytes()], pa.binary()), "digests": pa.array([digests.tobytes()], pa.binary()), "winners": pa.array([winners.astype(np.int64).tobytes()], pa.binary()),
        }
    )


def _look(asked: pa.Table, index: pa.Table) -> pa.Table:
    digests = _digests(asked.column("digest")) if len(asked) else np.zeros((0, 4), U)
    found, member = np.full(len(digests), -1, np.int64), np.zeros(len(digests), np.bool_)
    if len(index):
        row = index.slice(0, 1).to_pylist()[0]
        winners = np.frombuffer(row["winners"], np.int64)
        place = lookup(row["sizes"], np.frombuffer(row["bits"], np.uint8), np.frombuffer(row["digests"], U).reshape(-1, 4), np.arange(len(winners)), digests)
        member = place >= 0
        found[member] = winners[place[member]]
    return pa.table({"doc_id": asked.column("doc_id"), "digest": asked.column("digest"), "winner_id": pa.array(found, mask=~member), "member": pa.array(member)})


def _digested(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))


def index_of(history: DataFrame) -> tuple[DataFrame, int]:
    """The index of a history (doc_id, text), a row for each shard, and the number of shards.  Rows with a null are no part of it."""
    distinct = checkpointed(_digested(history).where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("winner")))
    shards = max(1, math.ceil(distinct.count() / SHARD_KEYS))
    return checkpointed(distinct.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(_build, INDEX)), shards


def exact_dedup(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """doc_id, winner_id and repeat for every document.

    winner_id is the lowest doc_id of the history that has the very same text; where the history has none, the lowest of `docs`.
    repeat says that the winner is another document.  Without a history, `docs` is its own.  A null text equals no text and an empty
    one equals empty ones.  A null doc_id can win nothing: such a row is a repeat if its text has a winner, else its winner_id is
    null.  Rows alike in doc_id and text are one document and give one row; a doc_id with several texts gives a row for each.  Other
    columns are ignored.
    """
    asked = _digested(docs)
    index, shards = index_of(docs if history is None else history)
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    rows = checkpointed(asked.where("digest is not null").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).withColumn("shard", shard))
    most = rows.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    copies = max(1, math.ceil(most / GROUP_ROWS))
    part = F.pmod(F.xxhash64("doc_id", "n"), F.lit(copies)).cast("int")
    look = rows.select("doc_id", "digest", "shard", part.alias("part")).groupBy("shard", "part")
    copied = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    found = checkpointed(look.cogroup(copied.groupBy("shard", "part")).applyInArrow(_look, "doc_id long, digest binary, winner_id long, member boolean"))

    members = found.where("member").select("doc_id", "winner_id")
    strangers = found.where("not member")
    own = strangers.groupBy("digest").agg(F.min("doc_id").alias("winner_id"))
    others = strangers.drop("winner_id").join(own, "digest").select("doc_id", "winner_id")
    empty = asked.where("digest is null").distinct().select("doc_id", F.col("doc_id").alias("winner_id"))
    out = members.unionByName(others).unionByName(empty)
    return out.select("doc_id", "winner_id", F.coalesce(~F.col("doc_id").eqNullSafe(F.col("winner_id")), F.lit(False)).alias("repeat"))


def repeats_removed(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """`docs` less the repeats of `exact_dedup`, columns as they came, whatever their names.  Of rows alike in doc_id and text one stays
    (a null text is like no other); rows of a doc_id that has several texts, or of a null doc_id, are judged each by its text."""
    named = docs.where("doc_id is not null")
    verdicts = checkpointed(exact_dedup(named, history))
    gone = verdicts.where("repeat").select("doc_id")
    unclear = checkpointed(_digested(named).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
    nameless = docs.where("doc_id is null")
    if unclear.isEmpty() and nameless.isEmpty():
        return without_ids(docs, gone)
    # The rare rows that a doc_id does not tell apart are compared by digest.
    odd_id, digest, row, other, late, winner = (fresh(docs, x) for x in ("odd", "digest", "row", "other", "late", "winner"))
    odd = docs.join(sized(unclear, 16).withColumnRenamed("doc_id", odd_id), F.col(odd_id) == docs["doc_id"], "left_semi").unionByName(nameless)
    one = odd.withColumn(digest, F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    one = one.withColumn(row, F.row_number().over(Window.partitionBy("doc_id", digest).orderBy(F.lit(1)))).where((F.col(row) == 1) | F.col(digest).isNull()).drop(row)
    pool = _digested(named).withColumn(late, F.lit(int(history is not None)))
    if history is not None:
        pool = pool.unionByName(_digested(history).withColumn(late, F.lit(0)))
    keep = pool.where("digest is not null and doc_id is not null").groupBy(F.col("digest").alias(other)).agg(F.min(F.struct(late, "doc_id"))["doc_id"].alias(winner))
    one = one.join(keep, F.col(digest) == F.col(other), "left").where(F.col(winner).isNull() | F.col(winner).eqNullSafe(F.col("doc_id"))).drop(digest, other, winner)
    return without_ids(without_ids(named, gone), unclear).unionByName(one)


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`exact_dedup` of all documents, which are their own history."""
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = """
SELECT DISTINCT doc_id, winner_id, winner_id <> doc_id AS repeat
FROM (SELECT doc_id, CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS winner_id FROM documents)
"""
