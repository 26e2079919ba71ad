"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import helpers_llm as H
import numpy as np
import pytest
from conftest import rows

from tillwise.llm import bag_minhash, byte_cnn, fertility, fm_index, hash_tree, packing, quotations, recompression
from tillwise.llm import toxicity, url_filter

LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(20000))
PASSAGE = " ".join(f"p{i}" for i in range(30))
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "alpha beta gamma"), (5, "alpha beta gamma"),
    (None, PASSAGE + " tail"), (6, "head " + PASSAGE), (7, "é" * 50 + " " + "ß 漢字 кириллица " * 9), (8, "!!! ### 123"),
    (9, "the " * 40), (10, "x " + "the " * 30), (None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    """With columns that operators might use themselves."""
    made = [(d, t, "en" if d and d % 2 else None, f"s{i}", 7, i, "k", [1.0]) for i, (d, t) in enumerate(TEXTS)]
    return spark.createDataFrame(made, f"{H.TABLE}, unit int, key string, bands array<double>")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_hash_tree(spark, docs, none):
    got = hash_tree.shard_documents(docs).collect()
    assert len(got) == len(TEXTS)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 1) for d, t in TEXTS
    )
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 16) and 0 <= r.shard < 16
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({r.shard for r in got if r.doc_id is None}) == len({r.shard for r in got if r.doc_id == 5}) == 1
    assert hash_tree.shard_documents(none).count() == 0


def test_hash_tree_spreads_the_rows_of_a_hot_key(spark, monkeypatch):
    """A third of all rows under one id, many of them equal: gapless slots, and no group of all of them."""
    monkeypatch.setattr(hash_tree, "ROWS_PER_BUCKET", 50)
    made = [(i, f"t{i}") for i in range(600)] + [(7, f"text {i % 150}") for i in range(200)] + [(7, "same")] * 300
    placed = hash_tree.shard_documents(spark.createDataFrame(made, "doc_id long, text string"))
    by = {}
    for r in placed.collect():
        by.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, by.values())) == 1100
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert placed.where("doc_id = 7").select("shard").distinct().count() == 1


def test_hash_tree_moves_only_inside_changed_subtrees(spark):
    keys = spark.range(6000).withColumnRenamed("id", "doc_id")
    tree = hash_tree.shard_tree(16)
    heavier = hash_tree.branch("", *tree.children[:3], hash_tree.Node("region3", 8.0, tree.children[3].children))
    moved = hash_tree.descend(hash_tree.descend(keys, keys.doc_id, tree), keys.doc_id, heavier, "later")
    pairs = {(a, b): n for a, b, n in moved.groupBy("shard", "later").count().collect() if a != b}
    assert pairs and all(b >= 12 for _, b in pairs)
    grown = hash_tree.descend(hash_tree.descend(keys, keys.doc_id, tree), keys.doc_id, hash_tree.shard_tree(17), "later")
    changed = [(a, b, n) for a, b, n in grown.groupBy("shard", "later").count().collect() if a != b]
    assert {b for _, b, _ in changed} == {16}
    assert 0.5 < sum(n for _, _, n in changed) / (6000 / 17) < 1.5


def test_url_filter(spark):
    long = "http://h.example.org/" + "a" * 100_000
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "HTTP://WWW.Example.COM/EN/?a=/#b"), (5, "x://h?q://z"), (5, "x://h?q://z"),
            (None, "http://a.net/es/1"), (6, "http://example.com/en/1"), (7, "http://notexample.com/en/1"), (8, long),
            (9, "http://www.example.com/en/"), (10, "http://com")]
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in urls], "page_id long, url string, host string, score int")
    got = url_filter.judge_urls(pages, url_filter.labelled_urls(spark))
    found = rows(got, "page_id", "host", "path", "rule")
    want = [(1, "", "", None), (2, "", "", None), (3, "", "", None), (4, "www.example.com", "/EN/", "com/"),
            (5, "h", "", None), (5, "h", "", None), (None, "a.net", "/es/1", "net/es/"),
            (6, "example.com", "/en/1", "example.com/en/"), (7, "notexample.com", "/en/1", "com/"),
            (8, "h.example.org", long[20:], None), (9, "www.example.com", "/en/", "www.example.com/en/"), (10, "com", "", None)]
    assert found == sorted(want, key=repr)
    assert {r.verdict for r in got.collect()} <= {"allow", "block"}
    assert got.where("rule = 'example.com/en/' OR rule = 'net/es/'").select("verdict").distinct().collect() == [("block",)]
    assert url_filter.judge_urls(pages.limit(0), url_filter.labelled_urls(spark)).count() == 0
    nothing = spark.createDataFrame([], "url string, label int")
    assert set(rows(url_filter.judge_urls(pages, nothing), "score")) == {(0.5,)}


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (9, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.5}


def test_byte_cnn(spark, docs, none):
    got = byte_cnn.identify(docs, byte_cnn.fit(docs)).collect()
    assert len(got) == len(TEXTS)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {1, 2, 3, 8, None} and all(r.score == 0 for r in got if r.lang_pred == "und")
    assert {r.lang_pred for r in got} == {"en", "und"}
    assert byte_cnn.identify(none, byte_cnn.fit(none)).count() == 0


def test_packing(spark, docs, none):
    got = packing.pack(docs, keep_ids=True).collect()
    lengths = {}
    for r in got:
        assert len(r.ids) == 4 * r.length
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths[1] == lengths[2] == lengths[3] == 1 and lengths[5] == 8 and lengths[4] > 2048
    whole = packing.sequences(spark.createDataFrame(got))
    assert sum(r.tokens for r in whole.collect()) == sum(lengths.values())
    assert all(len(r.ids) == 4 * r.tokens for r in whole.collect())
    assert packing.pack(none).count() == 0


def test_packer_keeps_few_windows_open_and_pads_little():
    rng = np.random.default_rng(5)
    packer = packing.Packer(64, 4, 2, 0, False)
    total = 0
    for doc in range(500):
        n = int(rng.integers(1, 150))
        total += n
        packer.document(doc, np.arange(n, dtype="<u4"))
        assert len(packer.open) <= 4
    packer.tighten()
    assert len(packer.open) <= 1
    packer.close(still_open=False)
    sizes = {}
    for row in packer.rows:
        sizes[row[5]] = sizes.get(row[5], 0) + row[2]
    assert sum(sizes.values()) == total and all(n >= 62 for n in sorted(sizes.values())[1:])


def test_fertility(docs, none):
    got = fertility.quality(docs).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        texts = [t for d, t in TEXTS if d == r.doc_id]
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts in [H.base_counts(t) for t in texts]
        if r.doc_id in (1, 2, 3, 5, 8):
            assert r.base_failed and not r.kept
    kept = fertility.keep_good(docs)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}
    assert fertility.quality(none).count() == fertility.keep_good(none).count() == 0


def test_recompression(spark, docs, none):
    gone = H.removed_words(TEXTS)
    want = []
    for i, (doc, text) in enumerate(TEXTS):
        ws = H.words(text)
        want.append((doc, len(ws), len(gone[i]), " ".join(w for k, w in enumerate(ws) if k not in gone[i])))
    assert rows(recompression.repeats(docs)) == sorted(want, key=repr)
    left = recompression.remove_repeats(docs)
    assert left.schema == docs.schema
    assert {(r.doc_id, r.text, r.n_chars) for r in left.where("doc_id = 10").collect()} == {(10, "x", 1)}
    assert {r.n_chars for r in left.where("doc_id = 4").collect()} == {7}
    assert recompression.repeats(none).count() == recompression.remove_repeats(none).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 20, 200])
def test_recompression_over_many_units(spark, monkeypatch, size):
    """Small vocabularies make runs and chance repeats; each document is a unit of its own."""
    from tillwise.llm import blocks

    rng = np.random.default_rng(size)
    base = [f"w{k}" for k in rng.integers(0, size, 60)]
    made = []
    for doc in range(24):
        a, n = rng.integers(0, 40), rng.integers(5, 30)
        ends = [[f"w{k}" for k in rng.integers(0, size, rng.integers(0, 20))] for _ in range(2)]
        made.append((int(rng.integers(0, 20)), " ".join([*ends[0], *base[a : a + n], *ends[1]])))
    gone = H.removed_words(made)
    want = sorted((d, len(H.words(t)), len(gone[i])) for i, (d, t) in enumerate(made))
    monkeypatch.setattr(blocks, "UNIT_BYTES", 1)
    found = recompression.repeats(spark.createDataFrame(made, "doc_id long, text string").repartition(5))
    assert rows(found, "doc_id", "n_words", "n_removed") == sorted(want, key=repr)


def test_bag_minhash(spark, docs, none):
    got = rows(bag_minhash.near_classes(docs))
    assert len(got) == len(TEXTS)
    assert [c for d, c in got if d is None] == [None, None]
    assert all(d == c for d, c in got if d not in (None, 10))
    stays = bag_minhash.drop_near_duplicates(docs)
    assert stays.schema == docs.schema
    assert sorted(r.doc_id for r in stays.where("doc_id IS NOT NULL").collect()) == [*range(1, 10)] + (
        [10] if dict(got)[10] == 10 else []
    )
    assert stays.where("doc_id IS NULL").count() == 2
    assert bag_minhash.near_classes(none).count() == bag_minhash.drop_near_duplicates(none).count() == 0


def test_bag_minhash_finds_a_group_around_its_origin(spark):
    """Copies that are near to the origin only, chains, and one id with two texts."""
    rng = np.random.default_rng(1)
    origin = [f"o{i}" for i in range(300)]
    made = []
    for doc in range(40):
        text = origin.copy()
        for at in rng.choice(300, 5, replace=False) if doc else ():
            text[at] = f"x{doc}_{at}"
        made.append((100 + doc if doc else 500, " ".join(text)))
    made += [(900 + i, " ".join(f"q{i}_{k}" for k in range(80))) for i in range(10)]
    made.append((901, " ".join(f"q2_{k}" for k in range(80))))
    got = dict(rows(bag_minhash.near_classes(spark.createDataFrame(made, "doc_id long, text string"))))
    assert {got[d] for d in [*range(101, 140), 500]} == {101}
    assert got[901] == got[902] == 901 and all(got[d] == d for d in (900, *range(903, 910)))


def test_signatures_agree_as_often_as_the_bags_overlap():
    rng = np.random.default_rng(2)
    key = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    a, b = rng.integers(1, 9, 400), rng.integers(1, 9, 400)
    b[:200] = a[:200]
    names = bag_minhash.signatures(np.repeat([0, 1], 400), np.tile(key, 2), np.concatenate([a, b]), 2, 4000)
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert (names[0] == names[1]).mean() == pytest.approx(expected, abs=0.03)


def test_fm_index(spark, docs, none):
    items = [(1, PASSAGE), (2, "Gamma"), (2, None), (3, ""), (None, "alpha"), (10, "the the THE"), (11, "word0, of0 word1"), (11, "beta")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = fm_index.benchmark_blocks(bench)
    got = fm_index.contamination(docs, blocks).collect()
    texts = sorted(zip(TEXTS, H.hits(items, [t for _, t in TEXTS])), key=repr)
    want = sorted((d, n, len(hit), sorted(names)) for (d, _), (n, hit, names) in texts if d is not None)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.items) for r in got if r.doc_id is not None) == want
    assert len(got) == len(TEXTS)
    many = fm_index.benchmark_blocks(bench, block_bytes=40)
    assert len(many) > 1 and sorted(map(repr, fm_index.contamination(docs, many).collect())) == sorted(map(repr, got))
    cut = fm_index.decontaminate(docs, blocks)
    assert cut.schema == docs.schema
    assert {(r.text, r.n_chars) for r in cut.where("doc_id = 6").collect()} == {("head ", 5)}
    assert cut.where("doc_id IN (5, 9)").count() == 0 and cut.where("doc_id < 4").count() == 3
    assert fm_index.contamination(none, blocks).count() == 0
    assert fm_index.contamination(docs, fm_index.benchmark_blocks(bench.limit(0))).where("n_hit > 0").count() == 0


def test_fm_index_is_set_up_in_time_that_grows_with_the_items():
    import time

    started = time.monotonic()
    block = fm_index.phrases_of([(str(i), f"word{i} and word{i + 1}") for i in range(40_000)])
    assert time.monotonic() - started < 10 and len(block.items) == len(block.phrases) == 40_000


def test_suffix_array_and_search_against_plain_text():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 300):
        symbols = rng.integers(0, size, 400)
        symbols[100:180] = symbols[200:280]
        shifted = np.append(symbols + 1, 0)
        order = fm_index.suffix_array(shifted)
        assert order.tolist() == sorted(range(401), key=lambda i: shifted[i:].tolist())
        index = fm_index.FMIndex(symbols, sampled=7)
        phrases = np.array([symbols[i : i + 4] for i in range(0, 380, 7)] + [[size + 3] * 4])
        low, high = index.search(phrases, np.full(len(phrases), 4))
        for phrase, a, b in zip(phrases, low, high, strict=True):
            want = [i for i in range(397) if symbols[i : i + 4].tolist() == phrase.tolist()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def message(conv, turn, text, role="user"):
    return (conv, turn, role, text, "x", 1)


def test_quotations_of_repeated_passages(spark, monkeypatch):
    """A passage that was said before belongs to the latest earlier message, in whatever stretch of turns."""
    import random

    monkeypatch.setattr(quotations, "STRETCH", 4)
    rng = random.Random(3)
    made, want = [], []
    for conv in range(3):
        said, roots_, depths = {}, {}, {}
        for turn in range(40):
            word, quote = rng.choice("abc"), rng.choice("abcd")
            asks = rng.random() < 0.7
            made.append((conv, turn, "u", f"> {quote}\n{word}" if asks else word))
            parent = said.get(quote) if asks else None
            roots_[turn], depths[turn] = (turn, 0) if parent is None else (roots_[parent], depths[parent] + 1)
            want.append((conv, turn, parent, roots_[turn], depths[turn], int(asks), int(parent is not None)))
            said[word] = turn
    got = quotations.link(spark.createDataFrame(made, "conv_id long, turn long, role string, text string"))
    assert sorted(tuple(r) for r in got.drop("role", "body").collect()) == sorted(want)


def test_quotations(spark):
    made = [
        message(1, 0, "First passage\nover two lines.\n\nSecond one."),
        message(1, 1, "> First   PASSAGE over\n> two lines.\nAnswer A"),
        message(1, 2, "> > second one.\n> nothing known\nAnswer B"),
        message(1, 3, ">> Second one.\n> answer a\n>\n> Answer B\nAnswer C"),
        message(1, 4, "> Answer C\n> later words\nD"),
        message(1, 5, "later words"),
        message(2, 0, "> Answer C"),
        message(2, 1, None), message(2, 2, ""), message(2, 2, ""), message(None, 1, "> Answer C\ny"), message(2, None, "Second one."),
    ]
    frame = spark.createDataFrame(made, "conv_id long, turn long, role string, text string, hash string, level int")
    got = rows(quotations.link(frame))
    want = [
        (1, 0, "user", "First passage\nover two lines.\n\nSecond one.", None, 0, 0, 0, 0),
        (1, 1, "user", "Answer A", 0, 0, 1, 1, 1),
        (1, 2, "user", "Answer B", None, 2, 0, 2, 1),
        (1, 3, "user", "Answer C", 2, 2, 1, 3, 3),
        (1, 4, "user", "D", None, 4, 0, 1, 0),
        (1, 5, "user", "later words", None, 5, 0, 0, 0),
        (2, 0, "user", "", None, 0, 0, 1, 0),
        (2, 1, "user", "", None, 1, 0, 0, 0),
        (2, 2, "user", "", None, 2, 0, 0, 0),
        (2, 2, "user", "", None, 2, 0, 0, 0),
        (2, None, "user", "Second one.", None, None, 0, 0, 0),
        (None, 1, "user", "y", None, 1, 0, 0, 0),
    ]
    assert got == sorted(want, key=repr)
    assert quotations.link(frame.limit(0)).count() == 0


def test_long_reply_chain(spark):
    chain = [message(7, t, (f"> text {t - 1}\n" if t else "") + f"text {t}") for t in range(70)]
    got = quotations.link(spark.createDataFrame(chain, "conv_id long, turn long, role string, text string, a string, b int"))
    assert rows(got, "turn", "root_turn", "depth") == sorted(((t, 0, t) for t in range(70)), key=repr)
