"""Numbered records of what is current: the last step of every change.

A record is a small JSON file that is written under another name and then renamed, so that
readers see it whole or not at all. One writer at a time; a second one is noticed by the
number it wants to take as well.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SUFFIX = ".json"


class Versions:
    """The records 1, 2, 3 and so on in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def numbers(self) -> list[int]:
        path, fs = hadoop(self.spark, self.path)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.removesuffix(_SUFFIX)) for n in names if n[0].isdigit() and n.endswith(_SUFFIX))

    def latest(self) -> int | None:
        return max(self.numbers(), default=None)

    def read(self, number: int) -> dict:
        path, fs = hadoop(self.spark, self._file(number))
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, number: int, record: dict) -> None:
        target, fs = hadoop(self.spark, self._file(number))
        aside, _ = hadoop(self.spark, f"{self.path}/.{number}-{uuid.uuid4().hex}")
        stream = fs.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(record).encode()))
        finally:
            stream.close()
        if fs.exists(target) or not fs.rename(aside, target):
            fs.delete(aside, False)
            raise RuntimeError(f"{target} was written by someone else")

    def delete(self, number: int) -> None:
        path, fs = hadoop(self.spark, self._file(number))
        fs.delete(path, False)

    def _file(self, number: int) -> str:
        return f"{self.path}/{number:08d}{_SUFFIX}"


class Publication:
    """Versions of several tables that become current by one record.

    Outside of :meth:`together` every change of a table is published at once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.versions = Versions(spark, path)
        self._pending: dict[str, int] | None = None

    def current(self) -> dict[str, int]:
        """The version of each table that readers see; inside the block also what it has written."""
        return self._published() | (self._pending or {})

    def move(self, table: str, version: int) -> None:
        if self._pending is not None:
            self._pending[table] = version
        else:
            self._publish({table: version})

    @contextmanager
    def together(self) -> Iterator[None]:
        """Publish all changes of the ``with`` block at its end, or none if it fails."""
        if self._pending is not None:
            raise RuntimeError("already inside a block")
        self._pending = {}
        try:
            yield
            pending, self._pending = self._pending, None
            if pending:
                self._publish(pending)
        finally:
            self._pending = None

    def _published(self) -> dict[str, int]:
        latest = self.versions.latest()
        return {} if latest is None else self.versions.read(latest)

    def _publish(self, changes: dict[str, int]) -> None:
        latest = self.versions.latest() or 0
        self.versions.write(latest + 1, self._published() | changes)


def hadoop(spark: SparkSession, path: str):
    """A path and its file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
