"""Toxicity scores by FTRL-proximal logistic regression.

Features are hashed words, pairs of neighbours and pairs with one or two words between. Every
coordinate has its own learning rate and the L1 term keeps most weights at zero, so the
model is a short list of buckets and weights that goes to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.splits import held_out
from tillwise.llm.text import ALNUM, LOWER, Words, mix, pieces, texts_of

BITS = 20
#: Labelled documents that a model is fitted on, about.
SAMPLE = 8192
EPOCHS = 4
THRESHOLD = 0.3
#: Rate, its smoothing, L1 and L2.
ALPHA, BETA, LASSO, RIDGE = 1.0, 1.0, 8.0, 1e-4
#: A feature needs so many documents of the sample.
LEAST_DOCUMENTS = 3


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features and the text of each; bucket 0 of every text is the bias."""
    n, hashes, text = len(words), words.hash, words.text
    texts = len(words.offsets) - 1
    buckets, owners = [np.zeros(texts, np.int64)], [np.arange(texts)]
    shift = np.uint64(64 - BITS)
    with np.errstate(over="ignore"):
        for gap in range(4):
            at = np.flatnonzero(words.windows(gap + 1)) if gap else np.arange(n)
            keys = hashes[at]
            if gap:
                keys = mix(keys * np.uint64(2 * gap + 1) + hashes[at + gap] + np.uint64(gap))
            buckets.append((keys >> shift).astype(np.int64) | 1)
            owners.append(text[at])
    return np.concatenate(buckets), np.concatenate(owners)


def _words(texts: pa.Array) -> Words:
    data, offsets = texts_of(texts)
    return Words(LOWER[data], offsets, ALNUM)


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            buckets, owners = features(_words(piece.column("text")))
            # each feature once per text
            keys = np.unique((owners << BITS) | buckets)
            bounds = np.searchsorted(keys >> BITS, np.arange(piece.num_rows + 1))
            low = (keys & ((1 << BITS) - 1)).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("place"),
                    piece.column("label"),
                    pa.array([low[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                ],
                names=["place", "label", "features"],
            )


def _learn(epochs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        rows: list[tuple[int, np.ndarray]] = []
        for batch in batches:
            for label, body in zip(batch.column("label").to_pylist(), batch.column("features").to_pylist()):
                rows.append((label, np.frombuffer(body, "<u4")))
        seen = np.zeros(1 << BITS, np.int32)
        for _, at in rows:
            seen[at] += 1
        rows = [(label, at[seen[at] >= LEAST_DOCUMENTS]) for label, at in rows]
        for _ in range(epochs):
            for label, at in rows:
                w = weights_of(z[at], n[at])
                p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
                g = p - label
                root = np.sqrt(n[at])
                n[at] += g * g
                z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w
        w = weights_of(z, n)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], names=["bucket", "weight"])

    return run


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights behind the sums of gradients ``z`` and of their squares ``n``."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - LASSO, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + RIDGE)


def training_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``place, label, text`` of about ``size`` labelled documents, chosen by a hash of the id.

    Only rows that are not held out; a document with several labels counts as toxic if
    one says so. The chosen labels are few, so they are broadcast to the documents.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("label"))
    )
    share = min(1.0, size / max(known.count(), 1))
    place = F.xxhash64("doc_id")
    chosen = known.where(F.pmod(place, F.lit(1 << 30)) < int(share * (1 << 30)))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        place.alias("place"), F.col("label").cast("int").alias("label"), "text"
    )


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, epochs: int = EPOCHS) -> pd.DataFrame:
    """``bucket, weight`` of the weights that are not zero.

    The features are made where the documents are read; one task then learns from the
    sample in the order of the hash. No labelled rows give no weights.
    """
    rows = training_sample(docs, labels, size).mapInArrow(
        _featurize, "place long, label int, features binary"
    )
    model = (
        rows.repartition(1)
        .sortWithinPartitions("place", "label", "features")
        .mapInArrow(_learn(epochs), "bucket long, weight double")
    )
    return model.toPandas()


def score(docs: DataFrame, model: pd.DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Return ``doc_id, held_out, score, predicted`` for every document.

    Whole texts, one pass, no shuffle. Null and empty texts get the score of the bias
    alone; repeated rows are scored alike and kept; other columns are not read.
    """
    at, weight = model["bucket"].to_numpy(np.int64), model["weight"].to_numpy(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS, np.float64)
        table[at] = weight
        for batch in batches:
            for piece in pieces(batch):
                buckets, owners = features(_words(piece.column("text")))
                some = np.flatnonzero(table[buckets])
                keys = np.unique((owners[some] << BITS) | buckets[some])
                sums = np.bincount(
                    keys >> BITS, table[keys & ((1 << BITS) - 1)], minlength=piece.num_rows
                )
                scores = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("held_out"),
                        pa.array(scores),
                        pa.array((scores >= threshold).astype(np.int32)),
                    ],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))
