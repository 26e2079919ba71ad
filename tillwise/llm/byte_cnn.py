"""Language identification by a convolutional network over bytes.

Filters of several widths slide over fixed-length windows of UTF-8 bytes; each filter keeps
its largest response in the window and a softmax layer turns these into languages. The
network is trained in numpy on a bounded sample of labelled texts. A text is cut into
windows without gaps, whatever its length; their probabilities are averaged by bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.splits import held_out
from tillwise.llm.text import byte_set, pieces, texts_of

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
#: Labelled documents of each language that a model is fitted on, about, and windows of each.
SAMPLE, WINDOWS_PER_TEXT = 1000, 4
UNKNOWN = "und"
_BATCH = 256

ASCII_LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A))


def _classes() -> np.ndarray:
    """Byte classes: 0 is padding, then other ASCII, digits, letters without case, each higher byte."""
    out = np.ones(256, np.int32)
    out[0x30:0x3A] = 2
    for i in range(26):
        out[0x41 + i] = out[0x61 + i] = 3 + i
    out[0x80:] = 29 + np.arange(128)
    return out


CLASSES = _classes()
N_CLASSES = int(CLASSES.max()) + 1


@dataclass
class Network:
    """One-hot byte filters ``[width, class, filter]``, their biases and the softmax layer."""

    languages: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pairs(self) -> list[tuple[list[np.ndarray], np.ndarray | None]]:
        """The filters as tables over pairs of neighbouring classes, and one over single ones."""
        tables = []
        for w in self.filters:
            double = [
                (w[k][:, None, :] + w[k + 1][None, :, :]).reshape(N_CLASSES * N_CLASSES, FILTERS)
                for k in range(0, len(w) - 1, 2)
            ]
            tables.append((double, w[-1] if len(w) % 2 else None))
        return tables

    def softmax(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes ``[position, window]``, the text of each window and its bytes; no text, no window."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][owner] + nth * WINDOW
    length = np.minimum(offsets[1:][owner] - start, WINDOW)
    at = start[None, :] + np.arange(WINDOW)[:, None]
    inside = np.arange(WINDOW)[:, None] < length[None, :]
    codes = CLASSES[data[np.minimum(at, len(data) - 1)]] * inside if len(owner) else np.zeros((WINDOW, 0), np.int32)
    return codes, owner, length


def pool(codes: np.ndarray, tables) -> np.ndarray:
    """The largest response of every filter in every window."""
    pair = codes[:-1] * N_CLASSES + codes[1:]
    out = []
    for double, single in tables:
        width = 2 * len(double) + (single is not None)
        steps = WINDOW - width + 1
        h = np.take(double[0], pair[:steps], axis=0)
        for k, table in enumerate(double[1:], 1):
            h += np.take(table, pair[2 * k : 2 * k + steps], axis=0)
        if single is not None:
            h += np.take(single, codes[width - 1 : width - 1 + steps], axis=0)
        out.append(h.max(axis=0))
    return np.concatenate(out, axis=1)


def train(codes: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = 1200, seed: int = 7) -> Network:
    """Fit by Adagrad on windows ``[position, window]``; every language is drawn equally often.

    A part of each batch is shortened, so that short texts are known too.
    """
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    net = Network(
        languages,
        [rng.normal(0, 0.3, (w, N_CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(total, np.float32),
        rng.normal(0, 0.2, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    params = [*net.filters, net.bias, net.out, net.out_bias]
    sums = [np.full_like(p, 1e-3) for p in params]
    groups = [np.flatnonzero(labels == k) for k in range(len(languages))]
    batch, rate = 64, 0.08
    for _ in range(steps):
        wanted = rng.integers(0, len(languages), batch)
        rows = np.array([groups[k][rng.integers(0, len(groups[k]))] for k in wanted])
        x = codes[:, rows].copy()
        keep = np.where(rng.random(batch) < 0.4, rng.integers(16, WINDOW, batch), WINDOW)
        x[np.arange(WINDOW)[:, None] >= keep[None, :]] = 0
        pooled, best = [], []
        for w in net.filters:
            n = WINDOW - len(w) + 1
            h = sum(np.take(w[k], x[k : k + n], axis=0) for k in range(len(w)))
            best.append(h.argmax(axis=0))
            pooled.append(h.max(axis=0))
        pooled = np.concatenate(pooled, axis=1)
        hidden = np.maximum(pooled + net.bias, 0)
        p = net.softmax(pooled)
        p[np.arange(batch), wanted] -= 1
        p /= batch
        back = (p @ net.out.T) * (hidden > 0)
        grads = []
        for i, w in enumerate(net.filters):
            g = np.zeros_like(w)
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            for k in range(len(w)):
                at = x[best[i] + k, np.arange(batch)[:, None]]
                np.add.at(g[k], (at, np.arange(FILTERS)[None, :]), own)
            grads.append(g)
        grads += [back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]
        for q, s, g in zip(params, sums, grads, strict=True):
            s += g * g
            q -= rate * g / np.sqrt(s)
    return net


def training_windows(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``place, lang, bytes``: windows from about ``size`` texts of each language, chosen by a hash.

    Each text gives up to ``WINDOWS_PER_TEXT`` windows spread over its whole length.
    """
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("doc_id"))
    )
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return known.select(F.lit(0).cast("long").alias("place"), "lang", F.lit(b"").alias("bytes")).limit(0)
    parts = (1 << 30) - 1
    share = F.create_map(
        *(x for lang, n in counts.items() for x in (F.lit(lang), F.lit(int(min(1.0, size / n) * parts))))
    )
    place = F.xxhash64("doc_id", "text")
    chosen = known.where(F.pmod(place, F.lit(1 << 30)) <= F.element_at(share, F.col("lang")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for place_, lang, text in zip(*(batch.column(n).to_pylist() for n in ("place", "lang", "text"))):
                body = text.encode()
                last = max(len(body) - WINDOW, 0)
                starts = sorted({last * k // (WINDOWS_PER_TEXT - 1) for k in range(WINDOWS_PER_TEXT)})
                rows += [(place_, lang, body[a : a + WINDOW]) for a in starts]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            types = (pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["place", "lang", "bytes"]
            )

    return chosen.select(place.alias("place"), "lang", "text").mapInArrow(
        cut, "place long, lang string, bytes binary"
    )


def fit(docs: DataFrame, size: int = SAMPLE) -> Network | None:
    """A network over the languages of the labelled rows; None without any such row."""
    rows = training_windows(docs, size).toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["place", "lang", "bytes"], kind="stable")
    languages = sorted(set(rows["lang"]))
    texts = pa.array(rows["bytes"].tolist(), pa.large_binary())
    codes, owner, _ = windows_of(*texts_of(texts))
    labels = rows["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy()[owner]
    return train(codes, labels, languages)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(ASCII_LETTERS[data])])
    found = np.diff(sums[offsets]) > 0
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")))
    return found


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """Return ``doc_id, held_out, lang_pred, score`` for every document.

    Whole texts, one pass, no shuffle. Null texts and texts without a letter are ``und``
    with score 0, as is everything without a network; repeated rows are judged alike and
    kept; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.pairs() if network else []
        names = np.array([*(network.languages if network else []), UNKNOWN], object)
        for batch in batches:
            for piece in pieces(batch):
                data, offsets = texts_of(piece.column("text"))
                known = _has_letter(data, offsets)
                best = np.full(piece.num_rows, len(names) - 1)
                score = np.zeros(piece.num_rows)
                if network and len(data):
                    sums = np.zeros((piece.num_rows, len(network.languages)))
                    codes, owner, length = windows_of(data, offsets)
                    for a in range(0, len(owner), _BATCH):
                        p = network.softmax(pool(codes[:, a : a + _BATCH], tables))
                        np.add.at(sums, owner[a : a + _BATCH], p * length[a : a + _BATCH, None])
                    at = sums.argmax(axis=1)
                    share = sums[np.arange(len(at)), at] / np.maximum(np.diff(offsets), 1)
                    best = np.where(known, at, best)
                    score = np.where(known, np.clip(share, 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("held_out"),
                        pa.array(names[best].tolist(), pa.string()),
                        pa.array(score),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    ).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return identify(docs, fit(docs))
