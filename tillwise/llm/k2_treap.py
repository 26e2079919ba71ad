"""Ranked lexical search with K2-treaps over the grid of terms and documents.

Each shard of documents is a grid: a row per term, a column per document, and in a cell the
impact of the term in the document. A node of the treap stands for a square of the grid. It keeps the
largest impact of its square, which its four quarters then lack, so a node is one point and
the largest value left is known at every step. Squares without points are not stored. A level
is three arrays: which quarters exist, by how much the value is below the parent's, and the
place of the point inside the square.

A query follows the paths of all its terms' rows at once. It keeps ranges of documents in
order of what any of their documents can reach at most: the scores found for them so far and, for
each term, the largest impact left below its node. The best ranges are halved first;
what cannot reach the k-th best score any more is never opened.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.text import ALNUM, LOWER, PIECE_BYTES, Words, pieces, texts_of
from tillwise.staging import stage

TOP = 20
#: Bytes of text in one shard; a longer text is a shard of its own.
SHARD_BYTES = 8 << 20
#: Bytes of query text that go to the tasks at a time.
BLOCK_BYTES = 4 << 20
#: Ranges that are halved in one step.
STEP = 64

_INDEX = (
    "doc_ids array<long>, height int, terms binary, checks binary, texts binary,"
    " nodes array<long>, quarters array<binary>, drops array<binary>, places array<binary>"
)
_POPCOUNT = np.array([bin(i).count("1") for i in range(16)], np.uint8)


# -------------------------------------------------------------------------- treap


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 31-bit numbers, each followed by a zero."""
    x = x.astype(np.int64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << shift)) & mask
    return x


def _gather(x: np.ndarray) -> np.ndarray:
    """Every second bit, the inverse of :func:`_spread`."""
    x = x & 0x5555555555555555
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> shift)) & mask
    return x


def _narrow(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers in as few bytes as the largest needs."""
    most = int(x.max(initial=0))
    return x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def _widen(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64)


def build_treap(row: np.ndarray, column: np.ndarray, value: np.ndarray, height: int) -> list[tuple[np.ndarray, ...]]:
    """The levels ``quarters, drops, places`` of the points' treap, from the whole grid down to single cells.

    Nodes of a level are in the order of their squares, four bits of ``quarters`` each.
    """
    code = 2 * _spread(row) + _spread(column)
    order = np.argsort(code)
    code, value = code[order], value[order]
    levels, before, before_value, before_quarters = [], np.zeros(0, np.int64), None, None
    for level in range(height + 1):
        if not len(code):
            break
        inner = 2 * (height - level)
        square = code >> inner
        head = np.flatnonzero(np.concatenate([[True], square[1:] != square[:-1]]))
        most = np.maximum.reduceat(value, head)
        segment = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(code))))
        largest = np.flatnonzero(value == most[segment])
        owner = segment[largest]
        chosen = largest[np.concatenate([[True], owner[1:] != owner[:-1]])]
        square = square[head]
        if level:
            parent = np.searchsorted(before, square >> 2)
            np.bitwise_or.at(before_quarters, parent, (1 << (square & 3)).astype(np.uint8))
            drop = before_value[parent] - most
        else:
            drop = most
        before, before_value, before_quarters = square, most, np.zeros(len(head), np.uint8)
        levels.append((before_quarters, _narrow(drop), _narrow(code[chosen] & ((1 << inner) - 1))))
        left = np.ones(len(code), bool)
        left[chosen] = False
        code, value = code[left], value[left]
    return levels


@dataclass
class Treap:
    """A treap unpacked for searches; nodes of all levels are numbered through.

    ``child`` is a node's first quarter, ``rest`` the largest value below a node.
    """

    height: int
    columns: int
    quarters: np.ndarray
    child: np.ndarray
    value: np.ndarray
    rest: np.ndarray
    row: np.ndarray
    column: np.ndarray

    @classmethod
    def of(cls, levels: list[tuple[np.ndarray, ...]], height: int, columns: int) -> Treap:
        first, square, value = 0, np.zeros(1, np.int64), None
        parts, rests = [], []
        for level, (quarters, drop, place) in enumerate(levels):
            value = drop.astype(np.int64) if level == 0 else value - drop
            code = (square << (2 * (height - level))) | place
            count = _POPCOUNT[quarters].astype(np.int64)
            first += len(quarters)
            ends = np.cumsum(count)
            parts.append((quarters, first + ends - count, value, _gather(code >> 1), _gather(code)))
            if level:
                rest = np.zeros(len(parent_count), np.int64)
                filled = parent_count > 0
                starts = (np.cumsum(parent_count) - parent_count)[filled]
                rest[filled] = np.maximum.reduceat(value, starts) if len(starts) else 0
                rests.append(rest)
            parent_count = count
            owner = np.repeat(np.arange(len(quarters)), count)
            bit = (quarters[:, None] >> np.arange(4, dtype=np.uint8)) & 1
            square = 4 * square[owner] + np.nonzero(bit)[1]
            value = value if level == len(levels) - 1 else value[owner]
        rests.append(np.zeros(len(parts[-1][0]), np.int64))
        quarters, child, value, row, column = (np.concatenate(x) for x in zip(*parts, strict=True))
        return cls(height, columns, quarters, child, value, np.concatenate(rests), row, column)

    def top(self, rows: np.ndarray, weights: np.ndarray, k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of those with the ``k`` highest sums of weighted values, and all that tie.

        ``rows`` are distinct, ``weights`` positive; sums under ``least`` are left out.
        """
        bits = max(0, self.columns - 1).bit_length()
        # the largest score found so far in each range of 2^shift columns, one level after the other
        sizes = [((self.columns - 1) >> s) + 1 for s in range(bits + 1)]
        offsets = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        found = np.zeros(sum(sizes), np.int64)
        done_columns, done_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def meet(nodes: np.ndarray) -> None:
            """Add the points that nodes hold in their paths' own rows."""
            there = np.flatnonzero((nodes >= 0) & (self.row[nodes] == rows))
            if not len(there):
                return
            node = nodes.reshape(-1)[there]
            columns = self.column[node]
            np.add.at(found, columns, self.value[node] * weights[there % len(rows)])
            scores = found[columns]
            for shift in range(1, bits + 1):
                np.maximum.at(found, offsets[shift] + (columns >> shift), scores)

        def bound(level: np.ndarray, prefix: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            rest = np.where(nodes >= 0, self.rest[nodes], 0) @ weights
            return found[offsets[np.minimum(self.height - level, bits)] + prefix] + rest, rest

        level, prefix = np.zeros(1, np.int64), np.zeros(1, np.int64)
        nodes = np.zeros((1, len(rows)), np.int64)
        meet(nodes)
        reach, rest = bound(level, prefix, nodes)
        while True:
            # ranges without anything left below have their final scores
            final = np.flatnonzero((rest == 0) & (reach >= least))
            if len(final):
                shift = np.minimum(self.height - level[final], bits)
                first = prefix[final] << shift
                size = np.minimum(first + (1 << shift), self.columns) - first
                columns = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                scores = found[columns]
                done_columns = np.concatenate([done_columns, columns[scores >= least]])
                done_scores = np.concatenate([done_scores, scores[scores >= least]])
                if len(done_scores) > k:
                    least = max(least, int(np.partition(done_scores, -k)[-k]))
                    kept = done_scores >= least
                    done_columns, done_scores = done_columns[kept], done_scores[kept]
            on = np.flatnonzero((rest > 0) & (reach >= least))
            if not len(on):
                return done_columns, done_scores
            best = on[np.argpartition(-reach[on], STEP)] if len(on) > STEP else on
            later = best[STEP:]
            best = best[:STEP]
            shift = self.height - level[best] - 1
            bit = (rows >> shift[:, None]) & 1
            parents = nodes[best]
            flags = np.where(parents >= 0, self.quarters[parents], 0)
            halves = []
            for side in (0, 1):
                quarter = 2 * bit + side
                there = (flags >> quarter) & 1 > 0
                below = self.child[parents] + _POPCOUNT[flags & ((1 << quarter) - 1)]
                halves.append((level[best] + 1, 2 * prefix[best] + side, np.where(there, below, -1)))
            new_level, new_prefix, new_nodes = (np.concatenate(x) for x in zip(*halves, strict=True))
            inside = (new_prefix << (self.height - new_level)) < self.columns
            new_level, new_prefix, new_nodes = new_level[inside], new_prefix[inside], new_nodes[inside]
            meet(new_nodes)
            level = np.concatenate([level[later], new_level])
            prefix = np.concatenate([prefix[later], new_prefix])
            nodes = np.concatenate([nodes[later], new_nodes])
            reach, rest = bound(level, prefix, nodes)


# -------------------------------------------------------------------------- index


def _words(column: pa.Array) -> Words:
    data, offsets = texts_of(column)
    return Words(LOWER[data], offsets, ALNUM)


def terms_of(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of 128 bits, in two halves, in order, and the number of every word among them."""
    keys, first, number = np.unique(key, return_index=True, return_inverse=True)
    checks = check[first]
    if (checks[number] == check).all():
        return keys, checks, number
    both, number = np.unique(np.stack([key, check], axis=1), axis=0, return_inverse=True)
    return both[:, 0], both[:, 1], number.reshape(-1)


def find_terms(keys: np.ndarray, checks: np.ndarray, key: np.ndarray, check: np.ndarray) -> np.ndarray:
    """The numbers of wanted terms among those of an index; -1 for one that it lacks."""
    at = np.searchsorted(keys, key)
    out = np.full(len(key), -1)
    on = np.flatnonzero(at < len(keys))
    while len(on):
        on = on[keys[at[on]] == key[on]]
        same = checks[at[on]] == check[on]
        out[on[same]] = at[on[same]]
        on = on[~same]
        at[on] += 1
        on = on[at[on] < len(keys)]
    return out


def impacts(tf: np.ndarray, size: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Millionths that a term weighs in a document of ``size`` terms: growing with tf, less in long documents."""
    m = 75 + 25 * size * documents // words
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


@dataclass
class _Shard:
    """The documents with a term of about so many bytes of text: ids, sizes, and the words' halves."""

    ids: list[int | None]
    sizes: np.ndarray
    key: np.ndarray
    check: np.ndarray


def _shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[_Shard]:
    """Neighbouring rows, over the ends of batches; words are hashed in pieces, which bounds the memory."""
    ids, parts, size = [], [], 0

    def shard() -> _Shard:
        return _Shard(ids, *(np.concatenate(x) for x in zip(*parts, strict=True)))

    for batch in batches:
        for piece in pieces(batch, limit=min(limit, PIECE_BYTES)):
            words = _words(piece.column("text"))
            held = np.flatnonzero(words.counts)
            ids += piece.column("doc_id").take(pa.array(held)).to_pylist()
            parts.append((words.counts[held], words.hash, words.second_hash))
            size += len(words.data)
            if size >= limit:
                if ids:
                    yield shard()
                ids, parts, size = [], [], 0
    if ids:
        yield shard()


def _index(documents: int, words_total: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, limit):
            keys, checks, number = terms_of(shard.key, shard.check)
            n = len(shard.ids)
            point, tf = np.unique(number * n + np.repeat(np.arange(n), shard.sizes), return_counts=True)
            del number
            row, column = point // n, point % n
            height = max(len(keys) - 1, n - 1).bit_length()
            levels = build_treap(row, column, impacts(tf, shard.sizes[column], documents, words_total), height)
            texts = np.bincount(row, minlength=len(keys)).astype("<u4")
            one = {
                "doc_ids": pa.array([shard.ids], pa.list_(pa.int64())),
                "height": pa.array([height], pa.int32()),
                "terms": pa.array([keys.astype("<u8").tobytes()], pa.binary()),
                "checks": pa.array([checks.astype("<u8").tobytes()], pa.binary()),
                "texts": pa.array([texts.tobytes()], pa.binary()),
                "nodes": pa.array([[len(q) for q, _, _ in levels]], pa.list_(pa.int64())),
                # two nodes a byte
                "quarters": pa.array([[_pairs(q).tobytes() for q, _, _ in levels]], pa.list_(pa.binary())),
                "drops": pa.array([[d.tobytes() for _, d, _ in levels]], pa.list_(pa.binary())),
                "places": pa.array([[p.tobytes() for _, _, p in levels]], pa.list_(pa.binary())),
            }
            yield pa.RecordBatch.from_arrays(list(one.values()), names=list(one))

    return run


def _pairs(nibbles: np.ndarray) -> np.ndarray:
    even = np.append(nibbles, np.zeros(len(nibbles) % 2, np.uint8))
    return even[::2] | (even[1::2] << np.uint8(4))


def _nibbles(data: bytes, n: int) -> np.ndarray:
    both = np.frombuffer(data, np.uint8)
    return np.stack([both & np.uint8(15), both >> np.uint8(4)], axis=1).reshape(-1)[:n]


@dataclass
class Index:
    """A row per shard in ``shards``; the numbers of documents with a term and of all their terms."""

    shards: DataFrame
    documents: int
    words: int


def build(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> Index:
    """Index every ``doc_id, text``; the shards are written. Nothing is shuffled.

    Null and empty texts and those without a term are in no shard. Repeated rows are documents
    of their own. Documents are read twice: impacts depend on the mean length.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = words = 0
        for batch in batches:
            for piece in pieces(batch):
                counts = _words(piece.column("text")).counts
                documents, words = documents + int((counts > 0).sum()), words + int(counts.sum())
        yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([words])], names=["documents", "words"])

    total = docs.select("text").mapInArrow(count, "documents long, words long").agg(F.sum("documents"), F.sum("words"))
    documents, words = (x or 0 for x in total.first())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return Index(stage(rows.mapInArrow(_index(documents, words, shard_bytes), _INDEX), "treaps"), documents, words)


# ------------------------------------------------------------------------- search


@dataclass
class Items:
    """A block of queries: distinct terms, and for item ``i`` its terms and their counts."""

    names: list[int | None]
    keys: np.ndarray
    checks: np.ndarray
    terms: list[np.ndarray]
    counts: list[np.ndarray]


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """Distinct rows ``item_id, text`` in blocks of about ``block_bytes``, dealt by a hash of both.

    One block at a time is on the driver.
    """
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for i in range(count):
        found = sorted({tuple(r) for r in rows.where(block == i).collect()}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        words = _words(pa.array([text for _, text in found], pa.large_string()))
        keys, checks, number = terms_of(words.hash, words.second_hash)
        own = [np.unique(number[a:b], return_counts=True) for a, b in zip(words.first, words.first[1:])]
        yield Items([name for name, _ in found], keys, checks, [t for t, _ in own], [n for _, n in own])


def _texts_with(block: Items, shards: DataFrame) -> np.ndarray:
    """In how many documents each of the block's terms occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.keys), np.int64)
        for batch in batches:
            for keys, checks, texts in zip(*(batch.column(c).to_pylist() for c in ("terms", "checks", "texts"))):
                at = find_terms(np.frombuffer(keys, "<u8"), np.frombuffer(checks, "<u8"), block.keys, block.checks)
                total += np.where(at >= 0, np.frombuffer(texts, "<u4")[at], 0)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "n"])

    out = np.zeros(len(block.keys), np.int64)
    counts = shards.select("terms", "checks", "texts").mapInArrow(run, "term long, n long")
    for term, n in counts.groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


def term_weights(texts: np.ndarray, documents: int) -> np.ndarray:
    """Thousandths of the log of how rare a term is, rounded down."""
    return np.floor(1000.0 * np.log((2.0 * documents + 2.0) / (2.0 * texts + 1.0))).astype(np.int64)


def _order(score: int, doc: int | None) -> tuple:
    return -score, doc is None, doc or 0


def _search(block: Items, weights: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the best of the shards read so far; a later shard has to reach the last of them
        best: list[list[tuple[int, int | None]]] = [[] for _ in block.names]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.slice(i, 1).to_pylist()[0]
                levels = [
                    (_nibbles(q, n), _widen(d, n), _widen(p, n))
                    for n, q, d, p in zip(shard["nodes"], shard["quarters"], shard["drops"], shard["places"], strict=True)
                ]
                ids = shard["doc_ids"]
                treap = Treap.of(levels, shard["height"], len(ids))
                at = find_terms(np.frombuffer(shard["terms"], "<u8"), np.frombuffer(shard["checks"], "<u8"), block.keys, block.checks)
                for item, (terms, counts) in enumerate(zip(block.terms, block.counts, strict=True)):
                    weight = weights[terms] * counts
                    on = (at[terms] >= 0) & (weight > 0)
                    if not on.any():
                        continue
                    least = best[item][-1][0] if len(best[item]) == k else 1
                    columns, scores = treap.top(at[terms[on]], weight[on], k, least)
                    both = best[item] + [(s, ids[c]) for s, c in zip(scores.tolist(), columns.tolist())]
                    best[item] = sorted(both, key=lambda x: _order(*x))[:k]
        rows = [(i, block.names[i], doc, score) for i, found in enumerate(best) for score, doc in found]
        item, name, doc, score = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (item, name, doc, score)], names=["item", "item_id", "doc_id", "score"]
        )

    return run


def search(index: Index, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Return ``item_id, rank, doc_id, score``: the ``k`` best documents of every item with a score above 0.

    Equal scores rank by ascending doc_id, null last. Rows with one item_id and different texts are answered
    each, equal rows once. An item with a null or empty text, or without a known term, has no
    rows, and neither has an empty index. Runs when called: a block of items goes to the tasks at
    a time, each task sends its best ``k`` per item, which are merged per item.
    """
    found = None
    for block in item_blocks(items, block_bytes):
        weights = term_weights(_texts_with(block, index.shards), index.documents)
        best = index.shards.mapInArrow(_search(block, weights, k), "item long, item_id long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        done = stage(ranked.select("item_id", "rank", "doc_id", "score"), "ranked")
        found = done if found is None else found.unionByName(done)
    return found


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    return search(build(spark.read.parquet(f"{folder}/documents.parquet")), spark.read.parquet(f"{folder}/benchmark.parquet"))


def oracle() -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = f"unnest(regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))"
    return f"""
      WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {terms} AS term FROM documents) GROUP BY ALL),
      q AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, {terms} AS term FROM benchmark) GROUP BY ALL),
      sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
      totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
      df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term),
      w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w FROM df, totals),
      m AS (SELECT doc_id, 75 + (25 * n * docs) // words AS m FROM sizes, totals),
      scores AS (
        SELECT q.item_id, tf.doc_id,
               CAST(sum(q.c * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * m.m))) AS BIGINT) AS score
        FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL),
      ranked AS (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS nth FROM scores WHERE score > 0)
      SELECT item_id, CAST(nth AS INTEGER) AS rank, doc_id, score FROM ranked WHERE nth <= {TOP}"""
