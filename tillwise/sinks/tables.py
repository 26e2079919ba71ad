"""Parquet tables made of load folders and a manifest.

Each write goes to a folder ``load=...`` of its own under the table's path. What counts is the
table's latest manifest, a small record beside the table's folder: it lists the parts that
hold the current rows (a load, or a month of a load), with their row counts and the bounds of
their key columns. A change writes its load first and its manifest last, so a run that fails
leaves readers with the previous state. A change of some months carries all other parts over by
name. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.contracts import Contract
from tillwise.operators.conform import conform
from tillwise.operators.merge import absent_rows, one_per_key, with_key
from tillwise.operators.validate import fail_on_violations, key_conflicts
from tillwise.sinks.versions import Publication, Versions, hadoop
from tillwise.staging import fits_broadcast, scratch, staged

LOAD = "load"
MONTH = "order_month"
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
#: Loads that a table may be made of before an append merges the small ones.
MOST_LOADS = 16


@dataclass(frozen=True)
class Part:
    """The rows of a load, or of one of its months; ``bounds`` of a column are null without values."""

    load: str
    month: str | None
    rows: int
    bounds: dict[str, list] = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    """The parts of a version, how many parts each load was written with, and the writer's notes."""

    parts: tuple[Part, ...] = ()
    written: dict[str, int] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    @classmethod
    def of(cls, record: dict) -> Manifest:
        return cls(tuple(Part(**p) for p in record["parts"]), record["written"], record["notes"])

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)


class ParquetTable:
    """A table at ``path`` with the columns of ``contract``.

    ``by_month`` names a date column; the files are then laid out by its month, so that
    reports over a period read only the months they need, and an upsert rewrites only the
    months it changes. With ``group`` the current version is the one that the group has
    published. ``merge`` turns the rows of several loads into fewer that mean the same; compaction
    uses it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        contract: Contract,
        by_month: str | None = None,
        *,
        group: Publication | None = None,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        most_loads: int = MOST_LOADS,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.contract = contract
        self.by_month = by_month
        self.group = group
        self.merge = merge
        self.most_loads = most_loads
        self.versions = Versions(spark, f"{self.path}-versions")

    # ------------------------------------------------------------------ reading

    def read(self, parts: Iterable[Part] | None = None) -> DataFrame:
        """The current rows, or those of some parts, in one scan.

        ``load`` and ``order_month`` come from the folder names, so a filter on the
        month reads only that month's files.
        """
        manifest = self.manifest()
        parts = manifest.parts if parts is None else parts
        return self._scan(self._paths(parts, manifest.written))

    def rows(self) -> DataFrame:
        """The current rows with exactly the contract's columns."""
        return self.read().select(*self.contract.names)

    def rows_near(self, batch: DataFrame, key: Sequence[str]) -> DataFrame:
        """The current rows of the parts whose bounds allow for a key of ``batch``.

        The bounds come from the manifest and one pass over the batch's key columns.
        """
        manifest = self.manifest()
        return self._scan(self._paths(_parts_near(manifest, batch, key), manifest.written)).select(*self.contract.names)

    def version(self) -> int | None:
        """The number of the current version; None before the first write."""
        if self.group is not None:
            return self.group.current().get(self.contract.name)
        return self.versions.latest()

    def manifest(self) -> Manifest:
        """The current manifest: one listing and one small file, however many loads there were."""
        version = self.version()
        return Manifest() if version is None else Manifest.of(self.versions.read(version))

    # ------------------------------------------------------------------ writing

    def append(self, df: DataFrame, notes: dict | None = None) -> list[Part]:
        """Add rows as they are; returns the new parts."""
        new = self.write_load(df)
        self.add(new, notes)
        return new

    def overwrite(self, df: DataFrame, notes: dict | None = None) -> None:
        """Replace the table by ``df``; readers see the old rows until the end."""
        self._commit(Manifest(notes=notes or {}), self.write_load(df, "full"))

    def insert_if_absent(
        self, batch: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
    ) -> list[Part]:
        """Add the batch rows whose key is new. Writes only those rows."""
        with scratch(self.spark):
            return self.append(self.absent(conform(batch, self.contract), key, order_by))

    def upsert(self, batch: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()) -> None:
        """Replace rows by key and add new ones.

        A table by month reads the keys of its parts that may hold one of the batch's, but not
        those of the batch's own months, and rewrites the months that lose or gain a row; any
        other table is rewritten.
        """
        batch = with_key(conform(batch, self.contract), key)
        with scratch(self.spark), staged(one_per_key(batch, key, order_by), f"{self.contract.name}-upsert") as fresh:
            manifest, touched = self.manifest(), None
            if self.by_month:
                touched = self._months(fresh.select(self._month().alias(MONTH)))
                others = [p for p in _parts_near(manifest, fresh, key) if p.month not in touched]
                if others:
                    held = self.read(others).select(*key, self._month().alias(MONTH))
                    touched |= self._months(_only_keys_of(held, fresh, key))
            old = [p for p in manifest.parts if touched is None or p.month in touched]
            kept = [p for p in manifest.parts if p not in old]
            rows = self.read(old).select(*self.contract.names)
            new = self.write_load(absent_rows(fresh, rows, key).unionByName(fresh), "months" if kept else "full")
        self._commit(Manifest(tuple(kept), manifest.written, manifest.notes), new)

    def load(self, batch: DataFrame, key: Sequence[str], check=None, order_by: Sequence[str] = ()) -> None:
        """Merge a batch: write the rows to insert as a load, check it, and then let it count.

        ``check`` gets the batch, written aside, and raises to refuse it. The rows to insert must
        not break a key of the contract beside the rows already held. A refused load
        leaves the table unchanged.
        """
        rows = conform(batch, self.contract)
        if check is None:
            with scratch(self.spark):
                new = self.write_load(self.absent(rows, key, order_by))
        else:
            with staged(rows, f"{self.contract.name}-batch") as rows:
                check(rows)
                with scratch(self.spark):
                    new = self.write_load(self.absent(rows, key, order_by))
        self.check_keys(self.rows_of(new), merged_on=key)
        self.add(new)

    def absent(self, batch: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
        """The batch rows that an insert would add; only parts near the batch's keys are read.

        Rows whose key is held go first, so a batch delivered again is not reduced to a row per key.
        """
        batch, parts = with_key(batch, key), self.manifest().parts
        if parts:
            held = self.rows_near(batch, key) if len(parts) > 1 else self.rows()
            batch = absent_rows(held, batch, key)
        return one_per_key(batch, key, order_by)

    def check_keys(self, new: DataFrame, merged_on: Sequence[str] = ()) -> None:
        """Raise if ``new`` rows would break a key of the contract beside the held ones.

        The key that the rows were ``merged_on`` cannot break.
        """
        others = [k for k in self.contract.keys if tuple(k) != tuple(merged_on)]
        if others:
            near = {tuple(k): self.rows_near(new, k) for k in others}
            fail_on_violations(key_conflicts(near, new, self.contract))

    def write_load(self, df: DataFrame, kind: str = "add") -> list[Part]:
        """Write a load that does not count yet; see :meth:`add`."""
        rows = conform(df, self.contract)
        number = 1 + max((int(f.split("=")[1].split("-")[0]) for f in self._folders()), default=0)
        name = f"{LOAD}={number:08d}-{kind}"
        writer = rows.write
        if self.by_month:
            rows = rows.withColumn(MONTH, self._month())
            # groups a month's rows, and splits a month that is too large for one task
            writer = rows.hint("rebalance", MONTH).write.partitionBy(MONTH)
        writer.parquet(f"{self.path}/{name}")
        return self._measured(name)

    def add(self, new: list[Part], notes: dict | None = None) -> None:
        """Let written parts count beside the current ones, and merge small loads if there are many."""
        manifest = self.manifest()
        self._commit(Manifest(manifest.parts, manifest.written, manifest.notes if notes is None else notes), new)
        if len({p.load for p in manifest.parts} | {p.load for p in new}) > self.most_loads:
            self.compact()

    def rows_of(self, parts: list[Part]) -> DataFrame:
        """The rows of parts, whether they count or not."""
        written = Counter(p.load for p in parts)
        return self._scan(self._paths(parts, written)).select(*self.contract.names)

    def compact(self) -> None:
        """Write the small loads anew as one.

        Small are the two smallest and every next one that has no more rows than those before it
        together, so a row is rewritten once per doubling of the table. A failure leaves the loads as they were.
        """
        manifest = self.manifest()
        sizes = Counter()
        for part in manifest.parts:
            sizes[part.load] += part.rows
        small, total = set(), 0
        for load, rows in sorted(sizes.items(), key=lambda x: (x[1], x[0])):
            if len(small) > 1 and rows > total:
                break
            small.add(load)
            total += rows
        if len(small) < 2:
            return
        kept = tuple(p for p in manifest.parts if p.load not in small)
        rows = self.read([p for p in manifest.parts if p.load in small]).select(*self.contract.names)
        new = self.write_load(rows if self.merge is None else self.merge(rows), "merged")
        self._commit(Manifest(kept, manifest.written, manifest.notes), new)

    def vacuum(self) -> None:
        """Delete what no reader of the current version needs: older versions, superseded and unfinished loads."""
        version = self.version()
        needed = {p.load for p in self.manifest().parts}
        for number in self.versions.numbers():
            if number != version:
                self.versions.delete(number)
        for name in self._folders():
            if name not in needed:
                path, fs = hadoop(self.spark, f"{self.path}/{name}")
                fs.delete(path, True)

    # ----------------------------------------------------------------- manifest

    def _commit(self, base: Manifest, new: list[Part]) -> None:
        parts = [*base.parts, *new]
        written = base.written | Counter(p.load for p in new)
        held = {p.load for p in parts}
        record = Manifest(tuple(parts), {k: n for k, n in written.items() if k in held}, base.notes)
        number = 1 + (self.versions.latest() or 0)
        self.versions.write(number, asdict(record))
        if self.group is not None:
            self.group.move(self.contract.name, number)

    def _measured(self, load: str) -> list[Part]:
        """The parts of a load that was just written: row counts and the bounds of the key columns."""
        columns = sorted({c for k in self.contract.keys for c in k})
        ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
        rows = self._scan([f"{self.path}/{load}"])
        counted = rows.groupBy(*([MONTH] if self.by_month else [])).agg(F.count(F.lit(1)).alias("_rows"), *ends)
        # one row a month
        return sorted(
            (
                Part(
                    load,
                    r[MONTH] if self.by_month else None,
                    r["_rows"],
                    {c: [_plain(r[f"lo_{c}"]), _plain(r[f"hi_{c}"])] for c in columns},
                )
                for r in counted.collect()
                if r["_rows"]
            ),
            key=lambda p: p.month or "",
        )

    # ------------------------------------------------------------------ folders

    def _month(self):
        return F.date_format(self.by_month, "yyyy-MM")

    def _months(self, rows: DataFrame) -> set[str | None]:
        # one row a month
        return {r[MONTH] for r in rows.select(MONTH).distinct().collect()}

    def _scan(self, paths: list[str]) -> DataFrame:
        schema = self.contract.schema.add(LOAD, "string")
        if self.by_month:
            schema = schema.add(MONTH, "string")
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    def _paths(self, parts: Iterable[Part], written: dict[str, int]) -> list[str]:
        """A folder for each load that is needed whole, else one for each of its months."""
        parts = list(parts)
        wanted = Counter(p.load for p in parts)
        whole = {load for load, n in wanted.items() if not self.by_month or written.get(load) == n}
        paths = {f"{self.path}/{load}": None for load in wanted if load in whole}
        paths |= {f"{self.path}/{p.load}/{MONTH}={p.month or _NO_MONTH}": None for p in parts if p.load not in whole}
        return list(paths)

    def _folders(self) -> list[str]:
        path, fs = hadoop(self.spark, self.path)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(n for n in names if n.startswith(f"{LOAD}="))


def _parts_near(manifest: Manifest, batch: DataFrame, key: Sequence[str]) -> Sequence[Part]:
    """The parts whose bounds allow for a key of ``batch``."""
    parts = manifest.parts
    if len(parts) > 1:
        columns = [c for c in key if any(c in p.bounds for p in parts)]
        ends = batch.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]) if columns else None
        if ends is not None:
            row = ends.first()
            wanted = {c: (_plain(row[f"lo_{c}"]), _plain(row[f"hi_{c}"])) for c in columns}
            parts = [p for p in parts if all(_meet(p.bounds.get(c), w) for c, w in wanted.items())]
    return parts


def _only_keys_of(held: DataFrame, fresh: DataFrame, key: Sequence[str]) -> DataFrame:
    """The held rows with a key of ``fresh``."""
    keys = fresh.select(*key)
    return held.join(F.broadcast(keys) if fits_broadcast(keys) else keys, list(key), "left_semi")


def _plain(value):
    """A bound as it stands in a manifest; values of one column keep their order."""
    if isinstance(value, dt.date):
        return value.isoformat()
    return float(value) if isinstance(value, Decimal) else value


def _meet(bounds: list | None, wanted: tuple) -> bool:
    """Whether two ranges may share a value. Without bounds they may; NaN is compared with nothing."""
    if bounds is None:
        return True
    if bounds[0] is None or wanted[0] is None:
        return False
    return not (bounds[1] < wanted[0] or wanted[1] < bounds[0])
