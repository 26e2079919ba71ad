"""Resampling towards a target distribution by importance weights, ranked by a distributed radix sort.

Runs of one and two words are hashed into a fixed number of buckets. The buckets' counts in the
corpus and in the target give an array of gains, a text's weight is the mean gain of its runs, and a
Gumbel draw added to it makes the highest scores a sample without replacement.

The ranks come from an LSD radix sort of Spark tables: a pass takes one digit of the composite
key (score downwards, doc_id upwards), counts it in each block of rows, sums the counts to the
global place where a block's rows of this digit begin, and writes every row with its
destination as the next pass's position. The order among equal digits is kept, so after the
last digit the position is the rank. No row meets more than its block in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.text import ALNUM, LOWER, Words, pieces, texts_of
from tillwise.staging import discard, stage

BUCKETS = 10_000
#: Documents of fewer words are never drawn.
LEAST_WORDS = 20
#: So many of a hundred documents are drawn.
PERCENT = 25
SEED = 7
#: A digit has so many bits at most, and a block of rows 2 ** BLOCK_BITS rows.
DIGIT_BITS = 14
BLOCK_BITS = 16
#: Longer words are hashed one by one.
_LONG = 64


# ---------------------------------------------------------------------- features


def _crc_table() -> np.ndarray:
    """CRC-32 of each byte, by the reflected polynomial."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = (value >> np.uint32(1)) ^ np.where(value & 1, np.uint32(0xEDB88320), np.uint32(0))
    return value


_CRC = _crc_table()
_ONES = np.uint32(0xFFFFFFFF)


def _step(state: np.ndarray, letter: np.ndarray) -> np.ndarray:
    return _CRC[(state ^ letter) & np.uint32(0xFF)] ^ (state >> np.uint32(8))


def crc_after(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 when the bytes ``start`` to ``end`` follow what has the CRC-32 ``before``, row by row.

    One array operation takes the next byte of all words that are as long.
    """
    size = end - start
    out = before.astype(np.uint32)
    short = np.flatnonzero(size <= _LONG)
    # the longest first, so that the words still running are a prefix
    order = short[np.argsort((_LONG - size[short]).astype(np.uint8), kind="stable")]
    state, at = out[order] ^ _ONES, start[order]
    running = np.searchsorted(-size[order], -np.arange(_LONG), "left")
    for k in range(_LONG):
        n = running[k]
        if not n:
            break
        state[:n] = _step(state[:n], data[at[:n] + k])
    out[order] = state ^ _ONES
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = zlib.crc32(data[start[i] : end[i]], int(out[i]))
    return out


def features(words: Words, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every run of one or two words."""
    one = crc_after(words.data, words.start, words.end, np.zeros(len(words), np.uint32))
    pairs = np.flatnonzero(words.windows(2))
    spaced = _step(one[pairs] ^ _ONES, np.uint32(0x20)) ^ _ONES
    two = crc_after(words.data, words.start[pairs + 1], words.end[pairs + 1], spaced)
    text = words.text
    return np.concatenate([text, text[pairs]]), np.concatenate([one, two]) % np.uint32(buckets)


def _words(piece: pa.RecordBatch) -> Words:
    data, offsets = texts_of(piece.column("text"))
    return Words(LOWER[data], offsets, ALNUM)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all of ``text``; one row per bucket reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch):
                total += np.bincount(features(_words(piece), buckets)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counts = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counts.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares, rounded down."""
    size = float(len(corpus))
    s, t = corpus.astype(float), target.astype(float)
    ratio = ((t + 1.0) * (s.sum() + size)) / ((s + 1.0) * (t.sum() + size))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


# ------------------------------------------------------------------------ scores


def _weigh(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                words = _words(piece)
                text, bucket = features(words, len(gain))
                n = np.bincount(text, minlength=piece.num_rows)
                # sums of integers far below 2^53 are exact
                total = np.bincount(text, gain[bucket].astype(float), piece.num_rows).astype(np.int64)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), pa.array(words.counts), pa.array(n), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return run


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel draw that depends on the id and the seed alone; null for a null id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))


# --------------------------------------------------------------------- radix sort


def key_parts(column: str, low: int, high: int, descending: bool = False) -> list[tuple[Column, int]]:
    """Parts of a long column as non-negative numbers and their bits, the least significant first.

    A range of fewer than 2^62 values is one part, any other range is its halves.
    """
    if high - low < 1 << 62:
        value = F.lit(high) - F.col(column) if descending else F.col(column) - F.lit(low)
        return [(value, (high - low).bit_length())]
    lower = F.col(column).bitwiseAND(F.lit(0xFFFFFFFF))
    upper = F.shiftright(column, 32)
    first, last = low >> 32, high >> 32
    if descending:
        lower, upper = F.lit(0xFFFFFFFF) - lower, F.lit(last) - upper
    else:
        upper = upper - F.lit(first)
    return [(lower, 32), (upper, (last - first).bit_length())]


def digits(parts: list[tuple[Column, int]], most: int = DIGIT_BITS) -> list[Column]:
    """The digits of the composite key, the least significant first; all have as many bits, if may be.

    Neighbouring parts are joined to one number where 62 bits hold it, so their bits share digits.
    """
    joined: list[tuple[Column, int]] = []
    for value, bits in parts:
        if joined and joined[-1][1] + bits <= 62:
            before, used = joined.pop()
            joined.append((F.shiftleft(value.cast("long"), used).bitwiseOR(before), used + bits))
        else:
            joined.append((value, bits))
    out = []
    for value, bits in joined:
        passes = -(-bits // most)
        width = -(-bits // passes) if passes else 0
        out += [F.shiftright(value, i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(passes)]
    return out


def counting_pass(rows: DataFrame, digit: Column, block_bits: int = BLOCK_BITS) -> DataFrame:
    """The rows with their ``position`` after a stable sort by ``digit``.

    Rows are shuffled once, by block and digit. A group has no more rows than a block. Of the
    counts, those of one digit meet in one group, a row for each block.
    """
    cut = rows.withColumn("_block", F.shiftright("position", block_bits)).withColumn("_digit", digit)
    counts = cut.groupBy("_block", "_digit").agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy("_digit").agg(F.sum("_n").alias("_n"))
    # one row per digit, 2 ** DIGIT_BITS at most
    before = F.sum("_n").over(Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("_digit", F.coalesce(before, F.lit(0)).alias("_base"))
    earlier = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.select("_block", "_digit", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_inside"))
    offsets = inside.join(bases, "_digit").select("_block", "_digit", (F.col("_base") + F.col("_inside")).alias("_first"))
    nth = F.row_number().over(Window.partitionBy("_block", "_digit").orderBy("position"))
    placed = cut.withColumn("_nth", nth).join(offsets, ["_block", "_digit"])
    return placed.withColumn("position", F.col("_first") + F.col("_nth") - 1).select(rows.columns)


def radix_sort(rows: DataFrame, parts: list[tuple[Column, int]], block_bits: int = BLOCK_BITS) -> DataFrame:
    """Rows whose distinct ``position`` becomes their place from 0 in the order of the key.

    ``parts`` are the key's parts from the least significant on. Each pass is a written table,
    and the one before it is deleted then. Rows with equal keys keep their order.
    """
    passes = digits(parts)
    if not passes:
        # all keys are equal: a single digit without information still makes positions gapless
        passes = [F.lit(0).cast("long")]
    held = None
    for digit in passes:
        done = stage(counting_pass(rows, digit, block_bits), "radix")
        if held is not None:
            discard(held)
        held = rows = done
    return rows


# ---------------------------------------------------------------------- resampling


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Return ``doc_id, n_features, weight, score, rank`` for every document.

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred (rounded
    down) with the highest scores have ranks from 1 on; equal scores rank by ascending doc_id,
    equal rows of one id in any order. Null and empty texts have no features, weight 0 and a
    score, but no rank. Rows without doc_id have no draw, so neither score nor rank, and do not
    count among those drawn from. Texts of any length are read whole. No documents give no rows;
    an empty target is a flat one. Other columns are not read. The driver gets the
    buckets' counts and the ends of the key; ``docs`` is read twice, rows of numbers are sorted.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    weighed = docs.select("doc_id", "text").mapInArrow(
        _weigh(gain), "doc_id long, n_words long, n_features long, weight long"
    )
    scored = stage(
        weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn(
            "position", F.monotonically_increasing_id()
        ),
        "scored",
    )
    columns = ["doc_id", "n_features", "weight", "score"]
    may = F.coalesce(F.col("n_words") >= least_words, F.lit(False)) & F.col("score").isNotNull()
    others = scored.where(~may).select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = scored.where(may).select(*columns, "position")
    ends = drawn.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{n}_{c}") for c in ("doc_id", "score") for n, f in (("low", F.min), ("high", F.max))],
    ).first()
    if not ends.n:
        return others
    parts = key_parts("doc_id", ends.low_doc_id, ends.high_doc_id)
    parts += key_parts("score", ends.low_score, ends.high_score, descending=True)
    ranked = radix_sort(drawn, parts, block_bits)
    rank = F.when(F.col("position") < percent * ends.n // 100, F.col("position") + 1)
    return ranked.select(*columns, rank.alias("rank")).unionByName(others)


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(docs, target)


def oracle() -> str:
    """CRC-32 is not a function of the dialect: it is folded over each distinct run's bytes."""
    table = "[" + ", ".join(f"{x}::BIGINT" for x in _CRC.tolist()) + "]"
    size = float(BUCKETS)

    def runs(source: str, key: str) -> str:
        lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"""
          SELECT {key}, ws, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS f
          FROM (SELECT {key}, regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM {source})"""

    return f"""
      WITH crc AS (SELECT {table} AS t),
      corpus AS ({runs("documents", "doc_id")}),
      target AS ({runs("benchmark", "item_id")}),
      known AS (SELECT DISTINCT f FROM (SELECT f FROM corpus UNION ALL SELECT f FROM target)),
      bytes AS (SELECT f, hex(encode(f)) AS h FROM known),
      hashed AS (
        SELECT f, xor(list_reduce(
                 list_transform(range(1, len(h) // 2 + 1), lambda i: ('0x' || h[2 * i - 1:2 * i])::BIGINT),
                 lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8), 4294967295::BIGINT), 4294967295) % {BUCKETS} AS bucket
        FROM bytes, crc),
      s AS (SELECT bucket, count(*) AS n FROM corpus JOIN hashed USING (f) GROUP BY bucket),
      t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (f) GROUP BY bucket),
      gain AS (
        SELECT b.bucket, CAST(floor(1000 * ln(
                 (CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT CAST(coalesce(sum(n), 0) AS DOUBLE) FROM s) + {size}))
                 / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * ((SELECT CAST(coalesce(sum(n), 0) AS DOUBLE) FROM t) + {size})))) AS BIGINT) AS g
        FROM (SELECT range AS bucket FROM range({BUCKETS})) b
        LEFT JOIN s ON s.bucket = b.bucket LEFT JOIN t ON t.bucket = b.bucket),
      weights AS (
        SELECT doc_id, count(*) AS n_features, CAST(floor(CAST(sum(g) AS DOUBLE) / count(*)) AS BIGINT) AS weight
        FROM corpus JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY doc_id),
      all_docs AS (
        SELECT d.doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight
        FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id),
      scored AS (
        SELECT *, weight + CAST(floor(-1000 * ln(-ln((
                 CAST(('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score,
               n_features >= {2 * LEAST_WORDS - 1} AS may
        FROM all_docs),
      ranked AS (
        SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS nth,
               count(*) OVER (PARTITION BY may) AS n FROM scored)
      SELECT doc_id, n_features, weight, score,
             CASE WHEN may AND nth <= {PERCENT} * n // 100 THEN nth END AS rank
      FROM ranked"""
