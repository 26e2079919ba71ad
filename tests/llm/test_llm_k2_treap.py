"""K2-treaps against plain sums and plain ranking."""

import math
import random
from collections import Counter

import helpers_llm as H
import numpy as np
import pytest

from tillwise.llm import k2_treap


def plain(docs, items, k=20):
    counts = [(d, Counter(H.item_words(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    N, L = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scores = []
        for doc, c in counts:
            n = sum(c.values())
            m = 100 - 25 + (25 * n * N) // L
            score = sum(
                math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in H.item_words(text)
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows, columns, share", [(1, 1, 1.0), (1, 40, 0.5), (300, 1, 0.7), (90, 33, 0.2), (17, 200, 0.9), (64, 64, 0.05)])
def test_treap_keeps_every_point_once_and_finds_the_top(rows, columns, share):
    rng = np.random.default_rng(rows + columns)
    row, column = np.nonzero(rng.random((rows, columns)) < share)
    value = rng.integers(1, 9 if columns == 200 else 10**6, len(row))
    height = max(rows - 1, columns - 1).bit_length()
    levels = k2_treap.build_treap(row, column, value, height)
    treap = k2_treap.Treap.of(levels, height, columns)
    assert sorted(zip(treap.row, treap.column, treap.value)) == sorted(zip(row, column, value))
    grid = np.zeros((rows, columns), np.int64)
    grid[row, column] = value
    for size in (1, 2, 7, 30):
        wanted = rng.choice(rows, min(size, rows), replace=False)
        weights = rng.integers(1, 50, len(wanted))
        sums = weights @ grid[wanted]
        for k, least in ((1, 1), (5, 1), (20, int(np.median(sums)) + 1), (1000, 1)):
            found, scores = treap.top(wanted, weights, k, least)
            assert len(set(found.tolist())) == len(found) and (sums[found] == scores).all()
            enough = np.sort(sums[sums >= least])[::-1]
            border = enough[min(k, len(enough)) - 1] if len(enough) else 0
            assert set(found.tolist()) >= set(np.flatnonzero((sums >= least) & (sums >= border)).tolist())


def test_search_opens_few_ranges():
    """Most of a large shard is never opened: the point of the bounds."""
    rng = np.random.default_rng(3)
    row, column = np.nonzero(rng.random((40, 4096)) < 0.3)
    value = rng.pareto(1.0, len(row)).astype(np.int64) + 1
    treap = k2_treap.Treap.of(k2_treap.build_treap(row, column, value, 12), 12, 4096)
    opened, whole = [], treap.rest

    class Counting(np.ndarray):
        def __getitem__(self, at):
            opened.append(np.size(at))
            return np.asarray(whole)[at]

    treap.rest = whole.view(Counting)
    treap.top(np.array([3, 30]), np.array([1, 1]), 5)
    assert sum(opened) < 2 * 4096


def test_odd_rows(spark):
    rng = random.Random(11)
    names = [f"t{i}" for i in range(40)] + ["Ünï", "漢字", "MiXed", "x9"]
    docs = [(i, " ".join(rng.choices(names, k=rng.randint(1, 40)))) for i in range(120)]
    docs += [(500 + i, "same words t1 t2") for i in range(60)]
    docs += [(None, "t1 t2 t3"), (None, None), (7, docs[7][1]), (7, "other t5"), (400, ""), (401, "!!!"), (402, "t1 " * 30_000)]
    items = [(1, "t1 t2 t1 unknown"), (2, None), (3, ""), (4, "nothing known"), (5, "mixed 漢字 ÜNÏ x9"), (5, "t5"), (1, "t1 t2 t1 unknown"), (None, "t7 same")]
    made = spark.createDataFrame([(*d, 1, "x", b"") for d in docs], "doc_id long, text string, item int, score string, terms binary")
    asked = spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, rank int")
    for shard, block in ((300, 1), (8 << 20, 4 << 20)):
        index = k2_treap.build(made.repartition(3), shard)
        got = k2_treap.search(index, asked, block_bytes=block)
        assert got.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
        assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, items)
    assert k2_treap.search(k2_treap.build(made.limit(0)), asked).count() == 0
    assert k2_treap.search(index, asked.limit(0)).count() == 0


def test_terms_with_one_hash_are_kept_apart():
    keys = np.array([5, 5, 9], np.uint64)
    checks = np.array([1, 2, 1], np.uint64)
    wanted = np.array([5, 5, 5, 9, 9, 10], np.uint64), np.array([2, 1, 3, 1, 2, 1], np.uint64)
    assert k2_treap.find_terms(keys, checks, *wanted).tolist() == [1, 0, -1, 2, -1, -1]
