"""Units of documents and sorted keys that travel as packed binaries.

A unit is a run of documents that one task handles at a time, kept as an Arrow stream in one
row of a written table, so that every later pass sees the same units. Keys of a unit are
cut into buckets by their leading bits; a bucket's keys of all units meet in one task.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import vocabulary
from tillwise.llm.text import pieces
from tillwise.session import batched
from tillwise.staging import stage

#: Bytes of text in a unit; a longer text is a unit of its own.
UNIT_BYTES = 4 << 20
#: Bytes of rows that a task hands to its worker at a time; a larger unit is handed over alone.
BATCH_BYTES = 4 << 20
#: Keys that one task compares, about.
BUCKET_KEYS = 2_000_000

_ZSTD = pa.Codec("zstd", 1)


def write_units(docs: DataFrame, weigh: Callable[[pa.RecordBatch], int]) -> DataFrame:
    """``unit, weight, body``: the rows of ``docs`` with all their columns, written once.

    ``weigh`` says how many keys a unit may have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary.forget()
        unit = TaskContext.get().partitionId() << 36
        for batch in batches:
            for piece in pieces(batch, limit=UNIT_BYTES):
                body = pack_unit(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([unit]), pa.array([weigh(piece)], pa.int64()), pa.array([body], pa.binary())],
                    names=["unit", "weight", "body"],
                )
                unit += 1

    with batched(docs.sparkSession, BATCH_BYTES):
        return stage(docs.mapInArrow(run, "unit long, weight long, body binary"), "units")


def pack_unit(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=_ZSTD)
    with pa.ipc.new_stream(sink, batch.schema, options=options) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_unit(body: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(body) as stream:
        return stream.read_next_batch()


def bucket_count(units: DataFrame) -> int:
    """As many buckets as keep one near ``BUCKET_KEYS``, but one per shuffle partition."""
    weight = units.agg(F.sum("weight")).first()[0] or 0
    least = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(weight / BUCKET_KEYS))


def packed(values: np.ndarray) -> bytes:
    """64-bit values, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + _ZSTD.compress(planes.tobytes(), asbytes=True)


def unpacked(body: bytes) -> np.ndarray:
    n = int.from_bytes(body[:8], "little")
    planes = np.frombuffer(_ZSTD.decompress(body[8:], 8 * n, asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def packed_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys, as the steps between them."""
    steps = keys.copy()
    steps[1:] -= keys[:-1]
    return packed(steps)


def unpacked_sorted(body: bytes) -> np.ndarray:
    return np.cumsum(unpacked(body), dtype=np.uint64)


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys, and their end."""
    return np.concatenate([[0], np.searchsorted(keys, _edges(buckets)), [len(keys)]])


@functools.lru_cache(maxsize=1)
def _edges(buckets: int) -> np.ndarray:
    """The first key of each bucket but the first; made once in a worker, not for each unit."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)


def answers_by_unit(answers: DataFrame, label: str) -> DataFrame:
    """``unit, <label>``: the written answers ``unit, bucket, bits`` of each unit."""
    with batched(answers.sparkSession, BATCH_BYTES):
        rows = stage(answers, label)
    return rows.groupBy("unit").agg(F.collect_list(F.struct("bucket", "bits")).alias(label))


def joined_bits(answers: list[dict] | None, bounds: np.ndarray) -> np.ndarray:
    """The flags of a unit's sorted keys from the answers of its buckets."""
    out = np.zeros(int(bounds[-1]), bool)
    for answer in answers or ():
        a, b = bounds[answer["bucket"]], bounds[answer["bucket"] + 1]
        out[a:b] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=int(b - a))
    return out
