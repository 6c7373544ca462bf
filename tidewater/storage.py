"""The folder that all executors share, and what is written there."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast up to so many bytes of rows.
BROADCAST_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: spark.checkpoint.dir, or where that is unset in a local session a temporary one."""
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidewater-"))
    return jsc.getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """`df`, computed once and written to the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df`, marked for broadcast if its rows, counted, of at most `row_bytes` each are within the limit; otherwise as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


#: Rows of the larger side that a task of a join or of an aggregate by key takes, about.
TASK_ROWS = 200_000


def tasks(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """In how many partitions `df`, counted, has about so many rows in each: as many as cores at least.  A repartitioning by number keeps to
    it, whatever the session's number of partitions is and however the planner merges them."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def joined(left: DataFrame, right: DataFrame, key: str, other: str, n: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The inner join on key = other: `right` is broadcast if its rows, counted, of at most `row_bytes` each are within the limit; otherwise
    both sides are merged in `n` partitions."""
    on = F.col(key) == F.col(other)
    if right.count() * row_bytes <= limit:
        return left.join(F.broadcast(right), on)
    return left.repartition(n, key).join(right.repartition(n, other).hint("merge"), on)


def blocks(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> list[DataFrame]:
    """`df` in parts by hash, each marked for broadcast and of about `limit` bytes at most if its rows have at most `row_bytes`: for joins
    on conditions that only a broadcast can serve.  Together the parts hold every row once."""
    n = max(1, -(-df.count() * row_bytes // limit))
    part = F.pmod(F.xxhash64(*df.columns), F.lit(n))
    return [F.broadcast(df.where(part == i) if n > 1 else df) for i in range(n)]
