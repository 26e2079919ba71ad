"""Session settings the library is written for."""

from __future__ import annotations

import math

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes one shuffle partition should hold, small enough to sort without spilling.
PARTITION_BYTES = 128 * 1024 * 1024
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Bytes that a byte of Parquet takes as rows in a sort or a hash table, about.
AS_ROWS = 8
#: Compressed shuffle bytes up to which adaptive execution merges partitions. Narrow rows take twenty
#: times as much in sorts and hash tables, and a task holds several of these.
MERGED_BYTES = 16 * 1024 * 1024
MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

#: Bytes of rows that a task and its Python worker hold as one Arrow batch, each its own copy.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

#: What the operators rely on. Adaptive execution splits the partition of a hot key even
#: where that costs an exchange: without the last entry it would not do so for a join whose
#: partitioning the following aggregate uses.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: For sessions of our own. No result depends on the zone; it only fixes what is printed.
OWN = {
    "spark.sql.session.timeZone": "UTC",
    # a job compiles more stages than the default of 100 kept ones
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def prepare(spark: SparkSession, size: int = 0) -> SparkSession:
    """Apply the runtime settings to a session that someone else built.

    With the bytes that will be read, shuffles start with enough partitions for them.
    """
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    if _bytes(spark, spark.conf.get(MERGED)) > MERGED_BYTES:
        spark.conf.set(MERGED, str(MERGED_BYTES))
    if size:
        size_shuffles(spark, size)
    return spark


def _bytes(spark: SparkSession, setting: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)


@contextmanager
def prepared(spark: SparkSession, size: int = 0) -> Iterator[SparkSession]:
    """The same for the length of a ``with`` block; the caller's settings come back after it."""
    before = {key: spark.conf.get(key, None) for key in (*RUNTIME, INITIAL, MERGED)}
    try:
        yield prepare(spark, size)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def batched(spark: SparkSession, limit: int) -> Iterator[None]:
    """What runs in the ``with`` block gives workers about ``limit`` bytes of rows at a time, but a row at least.

    A smaller limit of the caller holds.
    """
    before = spark.conf.get(BATCH)
    if 0 < _bytes(spark, before) <= limit:
        yield
        return
    spark.conf.set(BATCH, str(limit))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def build_session(app: str = "tillwise", **conf: str) -> SparkSession:
    """A session with the settings above and the given ones."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**RUNTIME, **OWN, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start shuffles with one partition per 128 MB of input.

    Adaptive execution merges what turns out too small, so the start value only
    has to be high enough for the largest exchange; it never goes below the
    session's own setting.
    """
    wanted = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(input_bytes / PARTITION_BYTES)
    )
    spark.conf.set(INITIAL, str(wanted))
    return wanted


def scanned_bytes(*frames: DataFrame) -> int:
    """Sizes of everything the frames read, as Catalyst knows them from the files."""
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        for i in range(leaves.size()):
            # without statistics a leaf counts as endless; then it says nothing
            size = int(str(leaves.apply(i).stats().sizeInBytes()))
            total += size if size < 1 << 62 else 0
    return total


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total length of the files under the given paths or patterns, asked from the file system."""
    total = 0
    for path in paths:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = fs.globStatus(hadoop_path)
        if not found:
            raise FileNotFoundError(path)
        for status in found:
            total += fs.getContentSummary(status.getPath()).getLength()
    return total
