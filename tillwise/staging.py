"""Written intermediates in the folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillwise-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def stage(df: DataFrame, label: str, *, outlive: bool = False) -> DataFrame:
    """Write ``df`` once as parquet and return a frame that reads it.

    Unlike a cache the files outlive lost executors, keep column statistics
    and let every later reader scan only the columns it needs. They stay until
    the end of the innermost :func:`scratch` block, with ``outlive`` that of the block
    around it; without a block until the shared folder is cleaned.
    """
    path = _new_path(df, label)
    blocks = _open.get()
    if outlive:
        blocks = blocks[:-1]
    if blocks:
        blocks[-1].append(path)
    return _write(df, path)


#: What stage() has written inside each of the open scratch() blocks of this thread, the innermost last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("tillwise-scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the ``with`` block what :func:`stage` wrote inside it.

    Jobs in other threads have blocks of their own.
    """
    written: list[str] = []
    outer = _open.set((*_open.get(), written))
    try:
        yield
    finally:
        _open.reset(outer)
        for path in written:
            _delete(spark, path)


def discard(frame: DataFrame) -> None:
    """Delete what :func:`stage` wrote for ``frame``, which nothing may read any more."""
    for path in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        _delete(frame.sparkSession, path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The same for the length of a ``with`` block; the files are deleted at its end."""
    path = _new_path(df, label)
    try:
        yield _write(df, path)
    finally:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _new_path(df: DataFrame, label: str) -> str:
    return f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, limit: int) -> bool:
    """True when Catalyst's own size estimate is within the limit."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def only_scans(df: DataFrame) -> bool:
    """True when the rows are read from files and only selected and computed row by row.

    Such a frame can be read again without shuffling or joining anything, and gives the same rows.
    """
    plans = [df._jdf.queryExecution().optimizedPlan()]
    while plans:
        plan = plans.pop()
        kind = plan.nodeName()
        if kind == "LogicalRelation":
            kind = plan.relation().getClass().getSimpleName()
        if kind not in ("Project", "Filter", "HadoopFsRelation") or not plan.deterministic():
            return False
        below = plan.children()
        plans += [below.apply(i) for i in range(below.size())]
    return True


def fits_broadcast(df: DataFrame) -> bool:
    """True when Catalyst's own size estimate is under its broadcast limit.

    The estimate of an unresolved or derived frame errs on the large side, so
    an unknown size counts as "does not fit".
    """
    state = df.sparkSession._jsparkSession.sessionState()
    return fits(df, state.conf().autoBroadcastJoinThreshold())
