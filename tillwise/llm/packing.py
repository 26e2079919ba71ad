"""Bounded-space online packing of token sequences.

Each task keeps a fixed number of open windows. A document's rest goes into the fullest
window that it fits (best fit); when none fits and no more may be opened, the fullest window
is emitted, topped up with the head of the rest if it would need more than a little padding.
The windows still open at the end of the tasks are merged in rounds of ever fewer tasks,
and the last one leaves a single window with padding.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import vocabulary
from tillwise.llm.text import LOWER, SPACED, Words, pieces, texts_of
from tillwise.staging import stage

LENGTH = 2048
OPEN_WINDOWS = 64
#: Tokens of padding that an emitted window may keep rather than cut a document.
LITTLE = 16
END = 1
#: Windows that one task merges.
MERGED_WINDOWS = 2048
_FLUSH = 20_000

_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
        ("open", pa.bool_()),
    ]
)
_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long, ids binary, open boolean"
)

#: doc_id, start, doc_tokens, ids
Piece = tuple[int | None, int, int, np.ndarray]


class Packer:
    """Places pieces into windows of ``length`` tokens, a bounded number of them open."""

    def __init__(self, length: int, windows: int, little: int, first_id: int, keep_ids: bool):
        self.length, self.windows, self.little, self.keep_ids = length, windows, little, keep_ids
        self.next_id = first_id
        #: (free tokens, number, pieces) by free tokens
        self.open: list[tuple[int, int, list[Piece]]] = []
        self.number = 0
        self.rows: list[tuple] = []

    def emit(self, pieces: list[Piece], still_open: bool = False) -> None:
        offset = 0
        for doc, start, total, ids in pieces:
            body = ids.tobytes()
            kept = body if still_open or self.keep_ids else None
            row = (doc, start, len(ids), zlib.crc32(body), total, self.next_id, offset, kept, still_open)
            self.rows.append(row)
            offset += len(ids)
        self.next_id += 1

    def _open(self, pieces: list[Piece], used: int) -> None:
        if used == self.length:
            self.emit(pieces)
        else:
            bisect.insort(self.open, (self.length - used, self.number, pieces))
            self.number += 1

    def place(self, pieces: list[Piece]) -> None:
        """Place pieces that belong together and have ``length`` tokens at most."""
        size = sum(len(p[3]) for p in pieces)
        at = bisect.bisect_left(self.open, (size,))
        if at < len(self.open):
            free, _, held = self.open.pop(at)
            self._open(held + pieces, self.length - free + size)
        elif len(self.open) < self.windows:
            self._open(pieces, size)
        else:
            free, _, held = self.open.pop(0)
            if free > self.little:
                head, pieces = cut(pieces, free)
                held = held + head
            self.emit(held)
            self.place(pieces)

    def document(self, doc: int | None, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.length
        for start in range(0, whole, self.length):
            self.emit([(doc, start, len(ids), ids[start : start + self.length])])
        if whole < len(ids):
            self.place([(doc, whole, len(ids), ids[whole:])])

    def tighten(self) -> None:
        """Fill the fullest windows from the emptiest, until one is left."""
        while len(self.open) > 1:
            free, _, held = self.open.pop(0)
            spare, _, pieces = self.open.pop()
            if self.length - spare <= free:
                self._open(held + pieces, self.length - free + self.length - spare)
            else:
                head, rest = cut(pieces, free)
                self.emit(held + head)
                self._open(rest, self.length - spare - free)

    def close(self, still_open: bool) -> None:
        for _, _, pieces in self.open:
            self.emit(pieces, still_open)
        self.open = []

    def flush(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)]
            self.rows = []
            yield pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def cut(pieces: list[Piece], size: int) -> tuple[list[Piece], list[Piece]]:
    """The first ``size`` tokens and the rest."""
    head: list[Piece] = []
    for i, (doc, start, total, ids) in enumerate(pieces):
        if len(ids) <= size:
            head.append(pieces[i])
            size -= len(ids)
        else:
            rest = pieces[i + 1 :]
            if size:
                head.append((doc, start, total, ids[:size]))
            return head, [(doc, start + size, total, ids[size:]), *rest]
    return head, []


def _first_id(round_: int) -> int:
    """Numbers of a task's sequences: round, task and a counter of 2^36."""
    return (round_ << 58) | (TaskContext.get().partitionId() << 36)


def _pack_texts(
    file: str, end: int, length: int, windows: int, little: int, keep_ids: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(length, windows, little, _first_id(0), keep_ids)
        vocabulary.forget(but=file)
        ids_of = vocabulary.token_ids_of(file)
        for batch in batches:
            for piece in pieces(batch):
                data, offsets = texts_of(piece.column("text"))
                # the vocabulary has no capitals, but names of special tokens are told by their case
                words = Words(data if b"<|" in data.tobytes() else LOWER[data], offsets, SPACED)
                ids, size = ids_of(words)
                bounds = np.concatenate([[0], np.cumsum(size)])[words.first]
                # one closing id after each text
                ids = np.insert(ids.astype("<u4"), bounds[1:], end)
                bounds = (bounds + np.arange(len(bounds))).tolist()
                for doc, a, b in zip(piece.column("doc_id").to_pylist(), bounds, bounds[1:]):
                    packer.document(doc, ids[a:b])
                yield from packer.flush(_FLUSH)
        packer.close(still_open=True)
        yield from packer.flush()

    return run


def _merge_windows(
    round_: int, last: bool, length: int, windows: int, little: int, keep_ids: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(length, windows, little, _first_id(round_), keep_ids)
        held, at = [], None
        names = ("doc_id", "start", "doc_tokens", "ids", "sequence_id")
        for batch in batches:
            for doc, start, total, ids, sequence in zip(*(batch.column(n).to_pylist() for n in names)):
                if sequence != at and held:
                    packer.place(held)
                    held = []
                at = sequence
                held.append((doc, start, total, np.frombuffer(ids, "<u4")))
            yield from packer.flush(_FLUSH)
        if held:
            packer.place(held)
        packer.tighten()
        packer.close(still_open=not last)
        yield from packer.flush()

    return run


def pack(
    docs: DataFrame,
    file: str | None = None,
    end: int = END,
    length: int = LENGTH,
    windows: int = OPEN_WINDOWS,
    little: int = LITTLE,
    keep_ids: bool = False,
) -> DataFrame:
    """Pack the tokens of ``text`` and a closing id per document into sequences.

    Returns a row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` (and ``ids``, unsigned 32-bit little-endian, if asked for). ``start`` counts the
    document's tokens before the piece, ``offset`` the sequence's. ``file`` names a tokenizer
    that drops white space. Null and empty texts are the closing id alone. Repeated rows are
    packed as often as they come, even with one id; no rows give no rows; other columns are
    not read. Texts of any length are cut into whole sequences and a rest. The documents are
    not shuffled; windows left open (at most ``windows`` per task) are.
    """
    file = file or vocabulary.path("word_bpe_49k.json")
    options = (length, windows, little, keep_ids)
    packed = stage(
        docs.select("doc_id", "text").mapInArrow(_pack_texts(file, end, *options), _DDL), "packed"
    )
    done, left, round_ = packed.where("NOT open"), packed.where("open"), 0
    while True:
        round_ += 1
        count = left.select("sequence_id").distinct().count()
        tasks = math.ceil(count / MERGED_WINDOWS)
        last = tasks <= 1
        dealt = left.coalesce(1) if last else left.repartition(tasks, "sequence_id")
        merged = stage(
            dealt.sortWithinPartitions("sequence_id", "offset").mapInArrow(
                _merge_windows(round_, last, *options), _DDL
            ),
            "merged",
        )
        done = done.unionByName(merged.where("NOT open"))
        if last:
            return done.drop("open") if keep_ids else done.drop("open", "ids")
        left = merged.where("open")


def sequences(pieces_: DataFrame) -> DataFrame:
    """The sequences of ``pack(..., keep_ids=True)``: ``sequence_id, tokens, ids``, pieces in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return pieces_.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), joined.alias("ids"))


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    return pack(spark.read.parquet(f"{folder}/documents.parquet"))
