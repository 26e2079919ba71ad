"""Importance resampling against a plain version, the radix sort against sorted()."""

import hashlib
import math
import random
import zlib
from collections import Counter

import helpers_llm as H
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillwise.llm import importance
from tillwise.llm.text import ALNUM, LOWER, Words, texts_of


def plain_features(text):
    ws = H.item_words(text)
    return ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]


def plain(docs, target, percent=25, least=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    s = Counter(bucket(f) for _, t in docs for f in plain_features(t))
    t = Counter(bucket(f) for x in target for f in plain_features(x))
    S, T = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * (S + 10000.0) / ((s[b] + 1.0) * (T + 10000.0))))

    rows = []
    for doc, text in docs:
        fs = plain_features(text)
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"7:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(fs), weight, score, len(H.item_words(text)) >= least and doc is not None))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0]))
    drawn = Counter()
    ranked = [(*r[:4], i + 1 if i < percent * len(order) // 100 else None) for i, r in enumerate(order)]
    return sorted(ranked + [(*r[:4], None) for r in rows if not r[4]], key=repr)


def test_features_are_crc_buckets():
    texts = ["One TWO two x", "", None, "ß漢 " + "w" * 200 + " end " + "é" * 64, "a"]
    data, offsets = texts_of(pa.array(texts, pa.large_string()))
    text, bucket = importance.features(Words(LOWER[data], offsets, ALNUM), 1 << 31)
    got = sorted(zip(text.tolist(), bucket.tolist()))
    assert got == sorted((i, zlib.crc32(f.encode()) % (1 << 31)) for i, t in enumerate(texts) for f in plain_features(t))


def test_odd_rows(spark):
    rng = random.Random(5)
    names = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(names, k=rng.randint(0, 60)))) for i in range(150)]
    docs += [(200, "same " * 30)] * 40 + [(-(2**63), " ".join(names)), (2**63 - 1, " ".join(names)), (7, docs[7][1])]
    docs += [(None, " ".join(names)), (None, None), (300, None), (301, ""), (302, "!!"), (303, "long " * 50_000)]
    target = [" ".join(names[:10] * 3), None, ""]
    made = spark.createDataFrame([(*d, 1, "x", 2.0) for d in docs], "doc_id long, text string, position int, score string, _block double")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(made, wanted, block_bits=4)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, target)
    assert importance.resample(made.limit(0), wanted).count() == 0
    flat = importance.resample(made, wanted.limit(0), block_bits=4)
    assert sorted((tuple(r) for r in flat.collect()), key=repr) == plain(docs, [])


@pytest.mark.parametrize("low, high", [(0, 0), (-5, 900), (-(2**63), 2**63 - 1), (10**12, 10**12 + 10**9)])
def test_radix_sort_orders_and_keeps_ties(spark, low, high):
    rng = random.Random(high)
    rows = [(rng.choice([low, high, rng.randint(low, high)]), rng.randint(-3, 3), i * 7) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, score long, position long").withColumn("was", F.col("position"))
    parts = importance.key_parts("doc_id", min(r[0] for r in rows), max(r[0] for r in rows))
    parts += importance.key_parts("score", -3, 3, descending=True)
    got = importance.radix_sort(df, parts, block_bits=5).orderBy("position").collect()
    assert [r.position for r in got] == list(range(500))
    assert [(r.doc_id, r.score, r.was) for r in got] == sorted(rows, key=lambda r: (-r[1], r[0], r[2]))


def test_gains_are_floored():
    got = importance.gains(np.array([0, 5, 9]), np.array([0, 5, 1]))
    want = [math.floor(1000 * math.log((t + 1) * 17 / ((s + 1) * 9))) for s, t in ((0, 0), (5, 5), (9, 1))]
    assert got.tolist() == want
