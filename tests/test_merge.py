"""Merging, conforming and table folders."""

import os
import uuid
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillwise import contracts as C
from tillwise.operators import merge as G
from tillwise.operators.conform import conform
from tillwise.sinks.tables import ParquetTable
from tillwise.staging import scratch, shared_folder, stage, staged

SCHEMA = "k int, j int, v int, w string"
KEY = ["k", "j"]


@pytest.fixture
def frame(spark):
    return lambda *r: spark.createDataFrame(list(r), SCHEMA)


@pytest.fixture
def folder(spark):
    return f"{shared_folder(spark)}/test-{uuid.uuid4().hex}"


def test_existing_rows_win_and_copies_in_the_batch_collapse(frame):
    target = frame((1, 1, 10, "old"))
    batch = frame((1, 1, 99, "new"), (2, 1, 7, "b"), (2, 1, 5, "z"), (2, 1, 5, "a"), (3, 1, None, "n"), (3, 1, 0, "m"))
    merged = G.insert_if_absent(target, batch, KEY)
    assert rows(merged) == [(1, 1, 10, "old"), (2, 1, 5, "a"), (3, 1, 0, "m")]
    assert rows(G.insert_if_absent(merged, batch, KEY)) == rows(merged)
    assert tuple(G.merge_counts(target, batch, KEY).first()) == (6, 3, 1, 2, 0)
    assert merged.count() == target.count() + 2


def test_null_keys_are_set_aside_and_counted(frame):
    target = frame((1, 1, 10, "old"))
    batch = frame((1, None, 1, "a"), (None, None, 2, "b"), (1, None, 1, "a"), (2, 1, 3, "c"))
    once = G.insert_if_absent(target, batch, KEY)
    assert rows(once) == [(1, 1, 10, "old"), (2, 1, 3, "c")]
    assert rows(G.insert_if_absent(once, batch, KEY)) == rows(once)
    assert rows(G.upsert(once, batch, KEY)) == rows(once)
    assert tuple(G.merge_counts(target, batch, KEY).first()) == (1, 0, 0, 1, 3)
    assert G.without_key(batch, KEY).count() == 3
    kept = target.unionByName(frame((None, 1, 5, "kept")))
    assert rows(G.upsert(kept, batch, KEY)) == rows(kept.unionByName(frame((2, 1, 3, "c"))))


def test_tie_break_column_decides(frame):
    batch = frame((1, 1, 1, "z"), (1, 1, 2, "a"))
    assert rows(G.first_per_key(batch, KEY, ["w"])) == [(1, 1, 2, "a")]
    assert G.first_per_key(batch, KEY, ["w"]).columns == batch.columns


def test_upsert_replaces(frame):
    target = frame((1, 1, 10, "old"), (2, 2, 20, "keep"))
    assert rows(G.upsert(target, frame((1, 1, 11, "new"), (3, 3, 30, "add")), KEY)) == [
        (1, 1, 11, "new"), (2, 2, 20, "keep"), (3, 3, 30, "add"),
    ]


def test_empty_batch_and_empty_target(frame):
    some = frame((1, 1, 1, "a"))
    assert rows(G.insert_if_absent(some, some.limit(0), KEY)) == rows(some)
    assert rows(G.insert_if_absent(some.limit(0), some, KEY)) == rows(some)
    assert tuple(G.merge_counts(some, some.limit(0), KEY).first()) == (0, 0, 0, 0, 0)


def test_small_batch_does_not_shuffle_the_table(spark, conf, folder):
    spark.range(3000).selectExpr("id AS k", "id AS v").write.parquet(f"{folder}/target")
    spark.range(2990, 3010).selectExpr("id AS k", "-id AS v").write.parquet(f"{folder}/batch")
    target, batch = (spark.read.parquet(f"{folder}/{n}") for n in ("target", "batch"))

    def plan_of(merge):
        return merge._jdf.queryExecution().executedPlan().toString()

    def merged():
        return G.rows_to_insert(target, batch, ["k"])

    want = [(k, -k) for k in range(3000, 3010)]
    assert rows(merged()) == sorted(want, key=repr)
    assert "BroadcastHashJoin [k" in plan_of(merged()) and "LeftSemi, BuildRight" in plan_of(merged())
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert rows(merged()) == sorted(want, key=repr)
    assert "LeftSemi" not in plan_of(merged()) and "SortMergeJoin" in plan_of(merged())


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """The first aggregate below the exchange leaves one row per key and task."""
    batch = spark.range(0, 30000, 1, 6).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    kept = G.first_per_key(batch, ["k"])
    assert kept.where("k = 0").first()["v"] == 0 and kept.count() == 20001
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert text.index("min(struct") < text.index("Exchange") < text.index("partial_min(struct")
    assert "Window" not in text


def test_only_rows_with_copies_are_shuffled_when_a_batch_lies_in_files(spark, conf, folder):
    """All ways to a row per key agree; the keys that have copies decide how it is taken."""
    spark.range(5000).selectExpr(
        "IF(id % 100 = 7, id % 1000, id) AS k", "IF(id % 3 = 0, NULL, id % 5) AS v", "IF(id % 11 = 0, NULL, sha2(string(id), 256)) AS w"
    ).write.parquet(f"{folder}/batch")
    batch = spark.read.parquet(f"{folder}/batch").where("k < 4900").withColumn("x", F.col("v") + 1)
    want = rows(G.first_per_key(batch, ["k"], ["x"]))
    assert len(want) == 4851 + 10

    def taken(frame):
        kept = G.one_per_key(frame, ["k"], ["x"])
        assert rows(kept) == want and kept.columns == batch.columns
        return kept._jdf.queryExecution().executedPlan().toString()

    assert "Join" not in taken(batch)  # a small one is reduced at once
    conf("spark.sql.autoBroadcastJoinThreshold", "50000")
    text = taken(batch)
    alone, several = text.split("LeftAnti", 1)[1].split("LeftSemi", 1)[0], text.split("LeftSemi", 1)[0]
    assert "Exchange hash" not in alone.split("SortAggregate")[0] and "Exchange hash" in several
    assert "Join" not in taken(spark.createDataFrame(batch.rdd, batch.schema))  # not in files
    assert "LeftAnti" not in taken(batch.join(spark.range(5000).selectExpr("id AS k"), "k", "left_semi"))
    conf("spark.sql.autoBroadcastJoinThreshold", "100")  # too many copies
    assert "Join" not in taken(batch)


def test_batch_in_files_is_merged_into_a_table_and_nothing_stays_aside(spark, conf, folder):
    conf("spark.sql.autoBroadcastJoinThreshold", "30000")
    spark.range(5000).selectExpr(
        "IF(id % 500 = 0, NULL, IF(id % 500 < 3, 1, id)) AS customer_id", "sha2(string(id), 256) AS name", "'u' || id AS username",
        "'u' || id || '@b.co' AS email", "1F AS latitude", "2F AS longitude",
    ).write.parquet(f"{folder}/batch")
    batch = spark.read.parquet(f"{folder}/batch")
    want = rows(G.first_per_key(G.with_key(batch, ["customer_id"]), ["customer_id"]), "customer_id", "username")
    assert len(want) == 5000 - 10 - 19
    table = ParquetTable(spark, f"{folder}/t", C.CUSTOMERS)
    with scratch(spark):
        assert "LeftAnti" in table.absent(batch, ["customer_id"])._jdf.queryExecution().executedPlan().toString()
    aside = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    table.load(batch, ["customer_id"])
    assert rows(table.rows(), "customer_id", "username") == want
    table.upsert(batch, ["customer_id"])
    assert rows(table.rows(), "customer_id", "username") == want
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == aside


def test_conform_modes(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1L, 1.005D, 'Low', 1, 2L, CAST(123456789.10 AS DECIMAL(28,2))),"
        " (2L, NULL, NULL, 1, 2L, CAST(1.10 AS DECIMAL(28,2)))"
        " AS t(customer_id, ltv, ltv_segment, recency, frequency, total_revenue)"
    )
    wide = conform(df, C.CUSTOMER_METRICS)
    assert [(f.name, f.dataType) for f in wide.schema] == [(f.name, f.dataType) for f in C.CUSTOMER_METRICS.schema]
    assert rows(wide, "ltv") == [(Decimal("1.0050"),), (None,)]
    lost = conform(df, C.CUSTOMER_METRICS, narrow=True, on_overflow="null")
    assert rows(lost, "customer_id", "total_revenue") == [(1, None), (2, Decimal("1.10"))]
    with pytest.raises(Exception, match="customer_metrics.total_revenue does not fit decimal"):
        conform(df, C.CUSTOMER_METRICS, narrow=True).collect()


# ------------------------------------------------------------------------ tables

TABLE = C.Contract(
    "t", (C.Column("k", C.INT), C.Column("d", C.DATE), C.Column("v", C.LONG)), primary_key=("k",)
)


@pytest.fixture
def batch(spark):
    return lambda *r: spark.createDataFrame(list(r), "k int, d string, v int").withColumn("d", F.to_date("d"))


@pytest.mark.parametrize("by_month", [None, "d"])
def test_table_modes(spark, folder, batch, by_month):
    table = ParquetTable(spark, folder, TABLE, by_month=by_month)
    assert table.rows().collect() == [] and table.rows().schema == TABLE.schema
    table.append(batch((1, "2023-01-05", 1)))
    table.insert_if_absent(batch((1, "2023-01-05", 9), (2, "2023-02-01", 2), (2, "2023-02-01", 3)), ["k"])
    assert rows(table.rows(), "k", "v") == [(1, 1), (2, 2)]
    table.upsert(batch((1, "2023-01-06", 9), (3, None, 3)), ["k"])
    assert rows(table.rows(), "k", "v") == [(1, 9), (2, 2), (3, 3)]
    table.overwrite(batch((7, "2022-12-31", 7)))
    assert rows(table.rows(), "k", "v") == [(7, 7)]
    assert rows(ParquetTable(spark, folder, TABLE, by_month=by_month).rows(), "k") == [(7,)]


def test_month_filter_reads_one_folder(spark, folder, batch):
    table = ParquetTable(spark, folder, TABLE, by_month="d")
    table.append(batch((1, "2023-01-05", 1), (2, "2023-02-01", 2)))
    table.append(batch((3, "2023-02-11", 3)))
    month = table.read().where("order_month = '2023-02'")
    assert rows(month, "k") == [(2,), (3,)]
    assert "PartitionFilters: [isnotnull(order_month" in month._jdf.queryExecution().executedPlan().toString()


def test_unfinished_write_is_invisible(spark, folder, batch):
    table = ParquetTable(spark, folder, TABLE)
    table.append(batch((1, "2023-01-05", 1)))
    batch((2, "2023-01-05", 2)).withColumn("v", F.col("v").cast("long")).write.parquet(f"{folder}/load=00000002-add")
    os.remove(f"{folder.removeprefix('file:')}/load=00000002-add/_SUCCESS")
    assert rows(table.rows(), "k") == [(1,)]
    table.append(batch((3, "2023-01-05", 3)))
    assert rows(table.rows(), "k") == [(1,), (3,)]


def test_failed_overwrite_leaves_the_old_rows(spark, folder, batch):
    table = ParquetTable(spark, folder, TABLE)
    table.append(batch((1, "2023-01-05", 1)))
    bad = batch((2, "2023-01-05", 2)).withColumn("v", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        table.overwrite(bad)
    assert rows(table.rows(), "k") == [(1,)]


def test_refused_load_changes_nothing_and_drops_the_stage(spark, folder, batch):
    table = ParquetTable(spark, folder, TABLE)
    seen = []

    def refuse(staged):
        seen.extend(staged.inputFiles())
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        table.load(batch((1, "2023-01-05", 1)), ["k"], check=refuse)
    assert table.rows().collect() == []
    assert seen and not any(os.path.exists(f.removeprefix("file://")) for f in seen)
    table.load(batch((1, "2023-01-05", 1)), ["k"])
    table.load(batch((1, "2023-01-05", 5)), ["k"])
    assert rows(table.rows(), "k", "v") == [(1, 1)]


def test_load_looks_at_held_rows(spark, folder, batch):
    contract = C.Contract("t", TABLE.columns, primary_key=("k",), unique=(("v",),))
    table = ParquetTable(spark, folder, contract)
    table.load(batch((1, "2023-01-05", 1)), ["k"])
    with pytest.raises(ValueError, match="v_unique: 1"):
        table.load(batch((2, "2023-01-05", 1)), ["k"])
    assert rows(table.rows(), "k", "v") == [(1, 1)]
    table.load(batch((1, "2023-01-05", 7), (2, "2023-01-05", 2)), ["k"])
    assert rows(table.rows(), "k", "v") == [(1, 1), (2, 2)]


def test_vacuum_keeps_what_readers_need(spark, folder, batch):
    table = ParquetTable(spark, folder, TABLE)
    table.append(batch((1, "2023-01-05", 1)))
    table.overwrite(batch((2, "2023-01-05", 2)))
    table.append(batch((3, "2023-01-05", 3)))
    table.vacuum()
    assert rows(table.rows(), "k") == [(2,), (3,)]
    assert sorted(os.listdir(folder.removeprefix("file:"))) == ["load=00000002-full", "load=00000003-add"]


def test_scratch_deletes_what_was_staged_inside(spark):
    with scratch(spark):
        files = [f.removeprefix("file://") for f in stage(spark.range(3), "three").inputFiles()]
        assert all(os.path.exists(f) for f in files)
    assert files and not any(os.path.exists(f) for f in files)


def test_staged_files_last_as_long_as_their_block(spark):
    with staged(spark.range(3), "three") as frame:
        files = [f.removeprefix("file://") for f in frame.inputFiles()]
        assert frame.count() == 3 and all(os.path.exists(f) for f in files)
    assert files and not any(os.path.exists(f) for f in files)
    with pytest.raises(ZeroDivisionError), staged(spark.range(0), "nothing") as frame:
        files = [f.removeprefix("file://") for f in frame.inputFiles()]
        1 / 0
    assert not any(os.path.exists(f) for f in files)
