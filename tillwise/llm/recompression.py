"""Substring deduplication by recompression.

Each text is a sequence of words that is compressed in rounds: runs ``a a a`` and pairs
``a b`` with a left symbol ``a`` and a right symbol ``b`` become new symbols. The sides are
drawn by a hash of the symbol and a symbol's name is a hash of what it stands for, so all
tasks name alike without a dictionary. Whether two neighbours merge depends on these two
only; equal substrings therefore get equal symbols inside, whatever surrounds them.

For each window of words the highest symbol border that the window alone determines is its
anchor, and the words that determine it are the anchor's name. Names shared by several
documents reveal where texts may repeat. There, the windows themselves are compared.
Windows without an anchor (such as one word over and over) are always compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import blocks, vocabulary
from tillwise.llm.fm_index import with_texts
from tillwise.llm.text import SPACED, Words, _power_tables, covered, mix, pieces, release, texts_of, window_hash

WINDOW = 13
ROUNDS = 5
#: Words whose anchors are looked for at a time; a longer text is worked on alone.
ANCHORED_WORDS = 1 << 17
_U = np.uint64
#: Bytes of text whose words a unit works on at a time; a longer text is a part of its own.
PART_BYTES = 1 << 19
#: A document without id comes after all others.
_NO_ID = np.iinfo(np.int64).max


# ---------------------------------------------------------------- recompression


class Symbols:
    """The symbols of one round over a run of texts.

    ``name`` and ``start`` (first word) of every symbol, ``opens`` true for the first symbol of
    a text. What decides that a symbol is one lies in the words ``[low, high)``; where a
    text's border takes part that is out of any window's reach.
    """

    def __init__(self, name, start, opens, low, high):
        self.name, self.start, self.opens, self.low, self.high = name, start, opens, low, high

    @classmethod
    def of_words(cls, hashes: np.ndarray, first: np.ndarray) -> Symbols:
        at = np.arange(len(hashes))
        opens = np.zeros(len(hashes) + 1, bool)
        opens[first] = True
        return cls(hashes, at, opens[:-1], at, at + 1)

    def round(self, number: int) -> tuple[Symbols, np.ndarray, np.ndarray, np.ndarray]:
        """The next symbols, and of the borders between them place, low and high."""
        name = self.name
        with np.errstate(over="ignore"):
            left = (mix(name + _U(0x9E3779B97F4A7C15 * number % 2**64)) >> _U(63)).astype(bool)
            same = np.concatenate([[False], (name[1:] == name[:-1])]) & ~self.opens
            pair = np.concatenate([[False], left[:-1] & ~left[1:]]) & ~self.opens & ~same
            border = ~(same | pair)
            begin = np.flatnonzero(border)
            count = np.diff(np.append(begin, len(name)))
            # a group is a run, or two runs where a pair stands between them
            head = count.copy()
            middle = np.flatnonzero(pair)
            group = np.cumsum(border)[middle] - 1
            head[group] = middle - begin[group]
            last = begin + count - 1
            merged = mix(
                name[begin] * _U(0xA0761D6478BD642F)
                + mix(name[last] + head.astype(np.uint64) * _U(0xE7037ED1A0B428DB))
                + count.astype(np.uint64) * _U(0x8EBC6AF09C88C6E3)
            )
        far = np.iinfo(np.int64).max // 2
        opens = self.opens[begin]
        closes = np.append(opens[1:], True)
        low = np.where(opens, -1, self.low[begin - 1])
        high = np.where(closes, far, self.high[np.minimum(last + 1, len(name) - 1)])
        inner = begin[~opens]
        borders = self.start[inner], self.low[inner - 1], self.high[inner]
        return (
            Symbols(np.where(count > 1, merged, name[begin]), self.start[begin], opens, low, high),
            *borders,
        )


def anchors(words: Words, hashes: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """For every window start the name of its anchor, and whether it has one.

    Of the borders that the window determines, those of the highest round count and of
    these the leftmost.
    """
    found, named = np.zeros(len(hashes), np.uint64), np.zeros(len(hashes), bool)
    whole, text = words.windows(window), 0
    while text < len(words.first) - 1:
        low = words.first[text]
        last = max(text + 1, int(np.searchsorted(words.first, low + ANCHORED_WORDS, "right")) - 1)
        some = slice(low, words.first[last])
        found[some], named[some] = _anchors(words.first[text : last + 1] - low, hashes[some], whole[some], window, rounds)
        text = last
    return found, named


def _anchors(
    first: np.ndarray, hashes: np.ndarray, whole: np.ndarray, window: int, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """The same for a run of texts that begin at the words ``first``."""
    n = len(hashes)
    found, named = np.zeros(n, np.uint64), np.zeros(n, bool)
    if not n:
        return found, named
    power, inverse = _power_tables(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * power[:n], out=sums[1:])
        symbols, at = Symbols.of_words(hashes, first), np.arange(n)
        for number in range(1, rounds + 1):
            symbols, place, low, high = symbols.round(number)
            near = (low >= 0) & (high - low <= window)
            place, low, high = place[near], low[near], high[near]
            if not len(place):
                break
            # low and high rise with place, so the first border right of the start decides
            before = np.cumsum(np.bincount(low + 1, minlength=n + 1)[:n])
            nearest = np.minimum(before, len(place) - 1)
            inside = whole & (before < len(place)) & (high[nearest] <= at + window)
            name = mix(
                (sums[high] - sums[low]) * inverse[low] + (place - low).astype(np.uint64) * _U(64) + _U(number)
            )
            found = np.where(inside, name[nearest], found)
            named |= inside
    return found, named


# ------------------------------------------------------------------- the passes


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)


class Part:
    """The words of some texts of a unit with their hashes."""

    def __init__(self, batch: pa.RecordBatch):
        self.words = Words(*texts_of(batch.column("text")), SPACED)
        self.hashes = self.words.hash
        self.ids = _ids(batch)

    def doc(self, at: np.ndarray) -> np.ndarray:
        """The ids of the documents that these words are in."""
        return self.ids[np.searchsorted(self.words.first, at, "right") - 1]

    def anchor_keys(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor names in order, their smallest and their largest ids.

        ``number`` gets the number of the name at each window start, or one of the two below.
        """
        name, named = anchors(self.words, self.hashes, window)
        doc = self.ids[self.words.text]
        # neighbouring windows share their anchor: one entry for each stretch
        change = np.ones(len(name), bool)
        change[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1]) | (named[1:] != named[:-1])
        change &= named
        at, stretch = np.flatnonzero(change), np.cumsum(change) - 1
        names, number = np.unique(name[at], return_inverse=True)
        low, high = np.full(len(names), _NO_ID), np.full(len(names), -1 - _NO_ID)
        np.minimum.at(low, number, doc[at])
        np.maximum.at(high, number, doc[at])
        self.number = np.where(self.words.windows(window), _UNNAMED, _SHORT).astype(np.int32)
        self.number[named] = number[stretch[named]]
        return names, low, high


#: In place of an anchor's number: no window starts here, or one without an anchor.
_SHORT, _UNNAMED = -2, -1


class Unit:
    """The words of a unit with their windows and anchors.

    Its texts are worked on a part at a time; what is kept of all of them is their words, the
    distinct keys and where these are.
    """

    def __init__(self, batch: pa.RecordBatch, window: int):
        self.batch, self.window = batch, window
        self.parts = [Part(piece) for piece in pieces(batch, limit=PART_BYTES)]

    @property
    def counts(self) -> np.ndarray:
        """The number of words of each text."""
        return np.concatenate([np.zeros(0, np.int64), *(part.words.counts for part in self.parts)])

    def anchor_keys(self) -> None:
        """Distinct anchor names in order, and the number of the name at each window start."""
        found = [part.anchor_keys(self.window) for part in self.parts]
        names = np.concatenate([np.zeros(0, np.uint64), *(names for names, _, _ in found)])
        self.names, number = np.unique(names, return_inverse=True)
        low = np.full(len(self.names), _NO_ID)
        high = np.full(len(self.names), -1 - _NO_ID)
        begin = 0
        for part, (names, least, most) in zip(self.parts, found, strict=True):
            own = number[begin : begin + len(names)]
            np.minimum.at(low, own, least)
            np.maximum.at(high, own, most)
            named = part.number >= 0
            part.number[named] = own[part.number[named]]
            begin += len(names)
        self.several = low < high

    def window_keys(self, shared: np.ndarray) -> None:
        """Distinct hashes of the windows to compare in order, their smallest ids, and where they start.

        A window is known by 128 bits: ``keys`` and, of two other functions of its words, ``second``.
        """
        compared = self.several | shared
        keys, second, doc = ([np.zeros(0, kind)] for kind in (np.uint64, np.uint64, np.int64))
        for part in self.parts:
            wanted = part.number == _UNNAMED
            named = part.number >= 0
            wanted[named] = compared[part.number[named]]
            part.at = np.flatnonzero(wanted)
            if len(part.at):
                keys.append(window_hash(part.hashes, self.window, 1)[part.at])
                second.append(window_hash(part.words.second_hash, self.window, 2)[part.at])
                doc.append(part.doc(part.at))
        keys, second, self.doc = np.concatenate(keys), np.concatenate(second), np.concatenate(doc)
        order, head = _ordered(keys, second)
        self.keys, self.second = keys[order[head]], second[order[head]]
        self.key = np.empty(len(keys), np.int64)
        self.key[order] = np.cumsum(head) - 1
        self.least = np.full(len(self.keys), _NO_ID)
        np.minimum.at(self.least, self.key, self.doc)

    def removed(self, before: np.ndarray) -> np.ndarray:
        """Words that a window covers whose text starts in an earlier document."""
        gone = before[self.key] | (self.doc > self.least[self.key])
        out, begin = [np.zeros(0, bool)], 0
        for part in self.parts:
            starts = np.zeros(len(part.words), bool)
            starts[part.at] = gone[begin : begin + len(part.at)]
            out.append(covered(starts, self.window))
            begin += len(part.at)
        return np.concatenate(out)


def _ordered(keys: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of 128-bit keys, and there true for the first of equal ones."""
    order = np.lexsort((second, keys))
    keys, second = keys[order], second[order]
    head = np.ones(len(keys), bool)
    head[1:] = (keys[1:] != keys[:-1]) | (second[1:] != second[:-1])
    return order, head


def _rows(names: list[str], columns: list[list], types: list[pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _per_unit(work: Callable[[int, Unit, dict], pa.RecordBatch], window: int):
    """A pass that returns what ``work`` makes of each unit; none outlives the next one's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary.forget()
        for batch in batches:
            for row in range(batch.num_rows):
                columns = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                number, body = columns.pop("unit"), columns.pop("body")
                yield work(number, Unit(blocks.read_unit(body), window), columns)
                release()

    return run


def _reveal(buckets: int, window: int):
    def work(number: int, unit: Unit, _: dict) -> pa.RecordBatch:
        unit.anchor_keys()
        bounds = blocks.bucket_bounds(unit.names, buckets)
        some = np.flatnonzero(np.diff(bounds)).tolist()
        keys = [blocks.packed_sorted(unit.names[bounds[b] : bounds[b + 1]]) for b in some]
        return _rows(
            ["unit", "bucket", "keys"], [[number] * len(some), some, keys], [pa.int64(), pa.int32(), pa.binary()]
        )

    return _per_unit(work, window)


def _answer(table: pa.Table, flags: np.ndarray, sizes: list[int]) -> pa.Table:
    bits, at = [], 0
    for size in sizes:
        bits.append(np.packbits(flags[at : at + size]).tobytes())
        at += size
    return pa.table({"unit": table["unit"], "bucket": table["bucket"], "bits": pa.array(bits, pa.binary())})


def _shared(table: pa.Table) -> pa.Table:
    """Flags of the keys that several units have."""
    parts = [blocks.unpacked_sorted(x) for x in table["keys"].to_pylist()]
    keys = np.concatenate(parts)
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    flags = np.zeros(len(keys), bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return _answer(table, flags, [len(p) for p in parts])


def _verify(buckets: int, window: int):
    def work(number: int, unit: Unit, columns: dict) -> pa.RecordBatch:
        unit.anchor_keys()
        unit.window_keys(blocks.joined_bits(columns["shared"], blocks.bucket_bounds(unit.names, buckets)))
        bounds = blocks.bucket_bounds(unit.keys, buckets)
        some = np.flatnonzero(np.diff(bounds)).tolist()
        keys = [blocks.packed_sorted(unit.keys[bounds[b] : bounds[b + 1]]) for b in some]
        second = [blocks.packed(unit.second[bounds[b] : bounds[b + 1]]) for b in some]
        least = [blocks.packed(unit.least[bounds[b] : bounds[b + 1]].view(np.uint64)) for b in some]
        return _rows(
            ["unit", "bucket", "keys", "second", "least"],
            [[number] * len(some), some, keys, second, least],
            [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()],
        )

    return _per_unit(work, window)


def _earlier(table: pa.Table) -> pa.Table:
    """Flags of the keys that a smaller id of another unit has."""
    parts = [blocks.unpacked_sorted(x) for x in table["keys"].to_pylist()]
    keys = np.concatenate(parts)
    second = np.concatenate([blocks.unpacked(x) for x in table["second"].to_pylist()])
    least = np.concatenate([blocks.unpacked(x) for x in table["least"].to_pylist()]).view(np.int64)
    order, first = _ordered(keys, second)
    head = np.flatnonzero(first)
    smallest = np.minimum.reduceat(least[order], head)
    flags = np.empty(len(keys), bool)
    flags[order] = np.repeat(smallest, np.diff(np.append(head, len(keys)))) < least[order]
    return _answer(table, flags, [len(p) for p in parts])


def _apply(buckets: int, window: int, render):
    def work(_: int, unit: Unit, columns: dict) -> pa.RecordBatch:
        unit.anchor_keys()
        unit.window_keys(blocks.joined_bits(columns["shared"], blocks.bucket_bounds(unit.names, buckets)))
        flags = blocks.joined_bits(columns["earlier"], blocks.bucket_bounds(unit.keys, buckets))
        return render(unit, unit.removed(flags))

    return _per_unit(work, window)


def _compared(docs: DataFrame, window: int, render, schema) -> DataFrame:
    def weigh(batch: pa.RecordBatch) -> int:
        return len(Words(*texts_of(batch.column("text")), SPACED))

    units = blocks.write_units(docs, weigh)
    buckets = blocks.bucket_count(units)
    bodies, answer = units.select("unit", "body"), "unit long, bucket int, bits binary"
    names = bodies.mapInArrow(_reveal(buckets, window), "unit long, bucket int, keys binary")
    shared = blocks.answers_by_unit(names.groupBy("bucket").applyInArrow(_shared, answer), "shared")
    revealed = bodies.join(shared, "unit", "left")
    windows = revealed.mapInArrow(
        _verify(buckets, window), "unit long, bucket int, keys binary, second binary, least binary"
    )
    earlier = blocks.answers_by_unit(windows.groupBy("bucket").applyInArrow(_earlier, answer), "earlier")
    return revealed.join(earlier, "unit", "left").mapInArrow(_apply(buckets, window, render), schema)


def _kept_texts(unit: Unit, removed: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The kept words of each text joined by blanks, and the number of removed ones."""
    texts, lost, begin = [], [np.zeros(0, np.int64)], 0
    for part in unit.parts:
        words, out = part.words, removed[begin : begin + len(part.words)]
        gone = np.diff(np.concatenate([[0], np.cumsum(out)])[words.first])
        data, offsets, first = words.data.tobytes(), words.offsets.tolist(), words.first.tolist()
        for i, some in enumerate(gone.tolist()):
            kept = data[offsets[i] : offsets[i + 1]].split()
            if some:
                kept = compress(kept, (~out[first[i] : first[i + 1]]).tolist())
            texts.append(b" ".join(kept).decode())
        lost.append(gone)
        begin += len(words)
    return texts, np.concatenate(lost)


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Return ``doc_id, n_words, n_removed, kept_text`` for every document.

    A word is removed if a window of ``window`` words covers it whose words also start in a
    document with a smaller id. Null and empty texts have no words and an empty kept text;
    rows with one id do not remove each other's words; a null id counts as the largest. No
    rows give no rows; other columns are not read.

    The texts are read three times from a written table and joined twice with a bit per
    key; what is compared are packed keys, each once per unit of documents, so neither a
    passage nor a document that a third of all rows share fills a task.
    """

    def render(unit: Unit, removed: np.ndarray) -> pa.RecordBatch:
        texts, gone = _kept_texts(unit, removed)
        return pa.RecordBatch.from_arrays(
            [
                unit.batch.column("doc_id").cast(pa.int64()),
                pa.array(unit.counts),
                pa.array(gone),
                pa.array(texts, pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_text"],
        )

    schema = "doc_id long, n_words long, n_removed long, kept_text string"
    return _compared(docs.select("doc_id", "text"), window, render, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without the words that :func:`repeats` removes; all columns stay.

    A text that loses words is its kept words joined by blanks, with ``n_chars`` counted
    anew where it is a column; all other texts stay as they are. A document that loses all
    its words goes.
    """

    def render(unit: Unit, removed: np.ndarray) -> pa.RecordBatch:
        texts, gone = _kept_texts(unit, removed)
        batch, before = unit.batch, unit.batch.column("text").to_pylist()
        if gone.any():
            changed = [new if lost else old for new, old, lost in zip(texts, before, gone.tolist(), strict=True)]
            batch = with_texts(batch, changed)
        return batch.filter(pa.array((unit.counts == 0) | (gone < unit.counts)))

    return _compared(docs, window, render, docs.schema)


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    found = repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
