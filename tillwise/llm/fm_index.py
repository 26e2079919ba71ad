"""Benchmark decontamination by FM-indexes of the training shards.

The benchmark's phrases are the queries. Each task indexes its shards of documents one by
one: the words become symbols, their suffix array gives the Burrows-Wheeler transform, a
wavelet matrix answers ranks on it. All phrases are searched backwards at once, occurrences
are located by walking to sampled suffix positions and overlapping spans are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import vocabulary
from tillwise.llm.text import ALNUM, LOWER, Words, pieces, texts_of

WINDOW = 10
#: Bytes of text in one index.
SHARD_BYTES = 4 << 20
#: One suffix position in so many is kept.
SAMPLED = 16
#: Bytes of benchmark text that go to the tasks at a time.
BLOCK_BYTES = 16 << 20


# ----------------------------------------------------------------------- index


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by doubling the compared length.

    The first sort compares as many symbols as fit into 62 bits; later ones only move
    suffixes that still tie.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length() + 1)
    step = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(step):
        key <<= bits
        key[: max(n - k, 0)] |= symbols[k:].astype(np.int64) + 1
    order = np.argsort(key, kind="stable")
    head = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
    at = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, at, 0))
    tied = np.flatnonzero(~(head & np.append(head[1:], True)))
    while len(tied):
        suffix = order[tied]
        follow = suffix + step
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        key = rank[suffix] * (n + 1) + second
        new = np.argsort(key, kind="stable")
        key, suffix = key[new], suffix[new]
        order[tied] = suffix
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[suffix] = np.maximum.accumulate(np.where(head, tied, 0))
        tied = tied[~(head & np.append(head[1:], True))]
        step *= 2
    return order


class WaveletMatrix:
    """Symbol access and ranks on a sequence, one level of bits at a time."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (sequence >> level) & 1
            ones = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(sequence) - int(ones[-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        first = np.zeros_like(at)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            up = ((symbols >> (self.bits - 1 - k)) & 1).astype(bool)
            at = np.where(up, zeros + ones[at], at - ones[at])
            first = np.where(up, zeros + ones[first], first - ones[first])
        return at - first

    def access(self, at: np.ndarray) -> np.ndarray:
        symbols = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            up = (ones[at + 1] - ones[at]).astype(bool)
            symbols = 2 * symbols + up
            at = np.where(up, zeros + ones[at], at - ones[at])
        return symbols


class FMIndex:
    """Counts and positions of phrases in a sequence of symbols from 0 on."""

    def __init__(self, symbols: np.ndarray, sampled: int = SAMPLED):
        # a last symbol below all others makes the order of the suffixes cyclic
        symbols = np.append(symbols + 1, 0)
        suffixes = suffix_array(symbols)
        counts = np.bincount(symbols)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.tree = WaveletMatrix(symbols[suffixes - 1], max(1, int(symbols.max()).bit_length()))
        kept = suffixes % sampled == 0
        self.kept = np.concatenate([[0], np.cumsum(kept)])
        self.places = suffixes[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of the suffixes that begin with each phrase.

        ``phrases`` holds one phrase a row, padded at the end.
        """
        known = len(self.first) - 2
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.first[-1], np.int64)
        for k in range(phrases.shape[1]):
            on = np.flatnonzero((high > low) & (lengths > k))
            symbols = phrases[on, lengths[on] - 1 - k] + 1
            absent = symbols > known
            high[on[absent]] = low[on[absent]]
            on, symbols = on[~absent], symbols[~absent]
            low[on] = self.first[symbols] + self.tree.rank(symbols, low[on])
            high[on] = self.first[symbols] + self.tree.rank(symbols, high[on])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in the given rows."""
        out = np.zeros(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            here = self.kept[rows + 1] > self.kept[rows]
            out[left[here]] = self.places[self.kept[rows[here]]] + steps
            left, rows = left[~here], rows[~here]
            symbols = self.tree.access(rows)
            rows = self.first[symbols] + self.tree.rank(symbols, rows)
            steps += 1
        return out


# --------------------------------------------------------------------- phrases


@dataclass
class Phrases:
    """Distinct phrases of a block of items, as symbols of the block's own vocabulary.

    ``items`` are the items' names in text order; phrase ``i`` is part of the items
    ``owners[bounds[i]:bounds[i + 1]]``. Items without name are one item, the last: None.
    """

    vocabulary: np.ndarray
    phrases: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray
    bounds: np.ndarray
    items: list[str | None]


def phrases_of(items: list[tuple[str | None, str]], window: int = WINDOW) -> Phrases | None:
    """The windows of items ``(id, text)``; a shorter item is one phrase; None without words."""
    def last(name: str | None) -> tuple[bool, str]:
        return name is None, name or ""

    items = sorted(items, key=lambda item: (last(item[0]), item[1]))
    names = sorted({name for name, _ in items}, key=last)
    data, offsets = texts_of(pa.array([text for _, text in items], pa.large_string()))
    words = Words(LOWER[data], offsets, ALNUM)
    if not len(words):
        return None
    vocabulary, symbols = np.unique(words.hash, return_inverse=True)
    counts = words.counts
    size = np.minimum(counts, window)[words.text]
    starts = np.flatnonzero(np.repeat(words.first[1:], counts) - np.arange(len(words)) >= size)
    length = size[starts]
    at = starts[:, None] + np.arange(window)
    inside = np.arange(window) < length[:, None]
    found = np.where(inside, symbols[np.minimum(at, len(symbols) - 1)], -1).astype(np.int32)
    number = {name: i for i, name in enumerate(names)}
    owner = np.array([number[name] for name, _ in items])[words.text[starts]]
    phrases, phrase = np.unique(found, axis=0, return_inverse=True)
    pairs = np.unique(phrase.reshape(-1) * len(names) + owner)
    return Phrases(
        vocabulary,
        phrases,
        (phrases >= 0).sum(axis=1),
        pairs % len(names),
        np.searchsorted(pairs // len(names), np.arange(len(phrases) + 1)),
        names,
    )


def benchmark_blocks(
    benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, window: int = WINDOW
) -> list[Phrases]:
    """The phrases of ``item_id, text`` in blocks of about ``block_bytes`` of text.

    Items are dealt to blocks by a hash of id and, without id, text; one block's text at a time
    reaches the driver. The words of items without id are hit but nobody's. What is returned
    grows with the benchmark, about 50 bytes a word, and goes to every task: a block bounds what is
    searched at a time, the benchmark bounds what is held.
    """
    rows = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64(F.coalesce("item_id", "text")), F.lit(count))
    found = (phrases_of([tuple(r) for r in rows.where(block == i).collect()], window) for i in range(count))
    return [x for x in found if x is not None]


# ---------------------------------------------------------------------- search


def find(words: Words, block: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hit words (flags), and the pairs (text, item) with an occurrence.

    Only runs of words from the block's vocabulary can hold a phrase: shorter runs than
    the shortest phrase are left out and what is left out separates the others.
    """
    n = len(words)
    none = np.zeros(n, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not n:
        return none
    hashes = words.hash
    symbol = np.minimum(np.searchsorted(block.vocabulary, hashes), len(block.vocabulary) - 1)
    known = block.vocabulary[symbol] == hashes
    edge = np.zeros(n + 1, bool)
    edge[words.first] = True
    starts = np.flatnonzero(known & (edge[:-1] | ~np.concatenate([[False], known[:-1]])))
    ends = np.flatnonzero(known & (edge[1:] | ~np.concatenate([known[1:], [False]]))) + 1
    long = ends - starts >= block.lengths.min()
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return none
    # each run is followed by a separator, symbol 0
    size = ends - starts + 1
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first - starts, size)
    last = first + size - 1
    symbols = symbol[np.minimum(place, n - 1)] + 1
    symbols[last] = 0
    index = FMIndex(symbols)
    low, high = index.search(block.phrases + 1, block.lengths)
    found = np.flatnonzero(high > low)
    count = (high - low)[found]
    rows = np.repeat(low[found] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    phrase = np.repeat(found, count)
    at = place[index.locate(rows)]
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + block.lengths[phrase], -1)
    pairs = np.unique(words.text[at] * len(block.phrases) + phrase)
    text, phrase = pairs // len(block.phrases), pairs % len(block.phrases)
    owners = block.bounds[phrase + 1] - block.bounds[phrase]
    item = block.owners[
        np.repeat(block.bounds[phrase] - (np.cumsum(owners) - owners), owners) + np.arange(int(owners.sum()))
    ]
    both = np.unique(np.repeat(text, owners) * len(block.items) + item)
    return np.cumsum(marks[:-1]) > 0, both // len(block.items), both % len(block.items)


def _hits(words: Words, blocks: list[Phrases]) -> tuple[np.ndarray, list[set[str]]]:
    hit, items = np.zeros(len(words), bool), [set() for _ in words.counts]
    for block in blocks:
        own, text, item = find(words, block)
        hit |= own
        for t, i in zip(text.tolist(), item.tolist(), strict=True):
            if block.items[i] is not None:
                items[t].add(block.items[i])
    return hit, items


def _words(batch: pa.RecordBatch) -> tuple[Words, np.ndarray]:
    data, offsets = texts_of(batch.column("text"))
    return Words(LOWER[data], offsets, ALNUM), data


def contamination(docs: DataFrame, blocks: list[Phrases]) -> DataFrame:
    """Return ``doc_id, n_words, n_hit, n_items, items, spans`` for every document.

    ``items`` are the ids of occurring items sorted as strings, ``spans`` the merged
    ``[first word, end)`` of what they cover. Null and empty texts have no words; repeated
    rows are searched alike and kept; other columns are not read. No shuffle: each task
    indexes the texts it reads in shards of about ``SHARD_BYTES``, a longer text alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary.forget()
        for batch in batches:
            for shard in pieces(batch, limit=SHARD_BYTES):
                words, _ = _words(shard)
                hit, items = _hits(words, blocks)
                sums = np.concatenate([[0], np.cumsum(hit)])
                starts, ends = _spans(hit, words)
                base = words.first[np.searchsorted(words.first, starts, "right") - 1]
                inner = np.stack([starts - base, ends - base], axis=1).tolist()
                at = np.searchsorted(starts, words.first).tolist()
                names = [sorted(x) for x in items]
                yield pa.RecordBatch.from_arrays(
                    [
                        shard.column("doc_id").cast(pa.int64()),
                        pa.array(words.counts),
                        pa.array(np.diff(sums[words.first])),
                        pa.array([len(x) for x in names], pa.int64()),
                        pa.array(names, pa.list_(pa.string())),
                        pa.array([inner[a:b] for a, b in zip(at, at[1:])], pa.list_(pa.list_(pa.int64()))),
                    ],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items", "spans"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_words long, n_hit long, n_items long, items array<string>, spans array<array<long>>",
    )


def _spans(hit: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Runs of hit words inside each text, as word numbers."""
    edge = np.zeros(len(hit) + 1, bool)
    edge[words.first] = True
    before, after = np.concatenate([[False], hit[:-1]]), np.concatenate([hit[1:], [False]])
    return np.flatnonzero(hit & (~before | edge[:-1])), np.flatnonzero(hit & (~after | edge[1:])) + 1


def decontaminate(docs: DataFrame, blocks: list[Phrases]) -> DataFrame:
    """The documents without the merged spans; the columns and all other text stay.

    A text is cut from the first to the last byte of each span; ``n_chars``, where it is a
    column, is counted anew for such texts. Rows that had words and have none left go.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary.forget()
        for batch in batches:
            for shard in pieces(batch, limit=SHARD_BYTES):
                words, data = _words(shard)
                hit, _ = _hits(words, blocks)
                if not hit.any():
                    yield shard
                    continue
                starts, ends = _spans(hit, words)
                owner = np.searchsorted(words.offsets, words.start[starts], "right") - 1
                left = words.counts - np.diff(np.concatenate([[0], np.cumsum(hit)])[words.first])
                texts = shard.column("text").to_pylist()
                for doc in np.unique(owner).tolist():
                    parts, at = [], int(words.offsets[doc])
                    for k in np.flatnonzero(owner == doc).tolist():
                        parts.append(data[at : words.start[starts[k]]].tobytes())
                        at = int(words.end[ends[k] - 1])
                    parts.append(data[at : words.offsets[doc + 1]].tobytes())
                    texts[doc] = b"".join(parts).decode()
                yield with_texts(shard, texts).filter(pa.array((words.counts == 0) | (left > 0)))

    return docs.select(names).mapInArrow(run, docs.schema)


def with_texts(batch: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
    """The batch with other texts and, if it has them, their numbers of characters."""
    names = batch.schema.names
    at = names.index("text")
    batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
    if "n_chars" in names:
        at = names.index("n_chars")
        kind = batch.schema.field(at)
        counts = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(kind.type)
        batch = batch.set_column(at, kind, counts)
    return batch


# ----------------------------------------------------------------------- query


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def query(spark, folder: str) -> DataFrame:
    blocks = benchmark_blocks(spark.read.parquet(f"{folder}/benchmark.parquet"))
    return digest(contamination(spark.read.parquet(f"{folder}/documents.parquet"), blocks))
