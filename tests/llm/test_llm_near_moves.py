"""What near-deduplication moves between tasks."""

import pytest

from tillwise.llm import bag_minhash

SCHEMA = "doc_id long, text string, _piece int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def texts_of(n):
    return [(i, " ".join(f"w{(i * 31 + k) % 9973}" for k in range(30)), i) for i in range(n)]


@pytest.mark.parametrize("most", [26, 15])
def test_rows_are_left_out_by_id_whatever_the_size_of_the_bitmap(spark, monkeypatch, most):
    monkeypatch.setattr(bag_minhash, "_MOST_BITS", most)
    rows = [(i, f"t{i}", 1) for i in (*range(-40000, 40000), 2**62, 7)] + [(None, "x", 2), (None, "x", 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    gone = {i for i in range(-40000, 40000) if i % 7 == 0}
    ids = spark.createDataFrame([(i,) for i in gone], "doc_id long")
    got = sorted(map(tuple, bag_minhash._without(docs, ids).collect()), key=str)
    assert got == sorted((r for r in rows if r[0] not in gone), key=str)


def test_no_ids_leave_all_rows(spark):
    docs = spark.createDataFrame([(1, "a", 1), (None, None, 2)], SCHEMA)
    assert bag_minhash._without(docs, docs.select("doc_id").limit(0)).count() == 2


def test_texts_that_surely_stay_are_not_shuffled(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = texts_of(50)
    docs = spark.createDataFrame([*rows, (99, rows[3][1], 0)], SCHEMA)
    once = bag_minhash.drop_near_duplicates(docs)
    text = plan(once)
    assert "Union" in text
    stay = text.split("Union", 1)[1].split("SortMergeJoin", 1)[0]
    assert "hashpartitioning(doc_id" not in stay
    assert sorted(r["doc_id"] for r in once.collect()) == list(range(50))


def test_a_text_is_signed_into_buckets_with_one_shuffle_of_its_bands(spark, conf, monkeypatch):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = {}

    def watched(df, label, **kwargs):
        plans.setdefault(label, plan(df))
        return original(df, label, **kwargs)

    original = bag_minhash.stage
    monkeypatch.setattr(bag_minhash, "stage", watched)
    bag_minhash.text_classes(spark.createDataFrame(texts_of(20), SCHEMA))
    assert "Join" not in plans["buckets"] and plans["buckets"].count("Exchange") == 1
    # the labels are joined without the bands
    below = plans["text-classes"].split("SortMergeJoin", 1)[1]
    assert "bands" not in below.split("Exchange", 1)[0]
    assert not any("bands" in line for line in below.splitlines() if "Exchange" in line)
