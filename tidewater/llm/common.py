"""What the corpus operators share: the shared folder, checked broadcasts and joins on them."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast up to so many bytes of rows; beyond it the join shuffles.
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
    """`df`, computed and written to the shared folder, so that a lost executor costs no recomputation of its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark's setting (4.1) to remove an execution's shuffle files as it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """`checkpointed`, and the shuffle files of the execution go as it ends, not when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, None)
    conf.set(CLEAN_UP, "true")
    try:
        # A plan of its own, so that `df` may run again.
        return checkpointed(df.select("*"))
    finally:
        if before is None:
            conf.unset(CLEAN_UP)
        else:
            conf.set(CLEAN_UP, before)


#: Rows, and bytes of them, that go to a Python worker at once at most.
BATCH_ROWS = 2_000
BATCH_BYTES = 16 << 20


def modest(df: DataFrame) -> DataFrame:
    """`df`, in a session whose batches for Python workers are small: texts are long, and a batch is held by the executor and the worker."""
    conf = df.sparkSession.conf
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(conf.get(name).rstrip("bB"))
        if now <= 0 or now > most:
            conf.set(name, str(most))
    return df


def give_back() -> None:
    """Returns to the system what the allocators keep for reuse: workers live on and serve other stages, and it would count against the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives its memory back when a task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def tidy_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A function for applyInArrow that gives its memory back after each group."""

    def wrapped(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return wrapped


def tidy_groups(run: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for cogroups."""

    def wrapped(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            give_back()

    return wrapped


def stored(df: DataFrame) -> DataFrame:
    """`df`, written as Parquet to the shared folder and read again."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def sized(small: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`small`, marked for broadcast if its rows, counted, of at most `row_bytes` each are within the limit; otherwise as it is, for Spark to
    sort and merge, which spills where it must."""
    return F.broadcast(small) if small.count() * row_bytes <= limit else small


def without_ids(docs: DataFrame, removed: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`docs` less the rows whose doc_id is in `removed`; rows with a null doc_id stay."""
    name = fresh(docs, "gone")
    gone = checkpointed(removed.select(F.col("doc_id").alias(name)).where(F.col(name).isNotNull()).distinct())
    return docs.join(sized(gone, 16, limit), docs["doc_id"] == gone[name], "left_anti")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have, from `name`."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
