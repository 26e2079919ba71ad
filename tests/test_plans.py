"""What the plans must look like, whatever the data."""

import os
import re
import uuid

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillwise.operators import validate as V
from tillwise.operators.aggregates import customer_totals
from tillwise.plans.job import run_job
from tillwise.session import INITIAL, MERGED, MERGED_BYTES, prepared, scanned_bytes
from tillwise.staging import shared_folder, staged


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, action):
    group = f"jobs-{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    action()
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(found)


@pytest.mark.parametrize("limit", ["10485760", "-1"])
@pytest.mark.parametrize(
    "name",
    ["seasonal_sales_metrics", "enriched_sales", "merge_sales", "merge_customers", "validation_report", "orphans",
     "invalid_lines", "customer_metrics", "key_duplicates", "lookup_keys"],
)
def test_no_cross_or_nested_loop_join_and_no_python(spark, conf, name, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    text = plan(E.queries()[name](spark, SMALL))
    assert not re.search("CartesianProduct|BroadcastNestedLoop|Python|Arrow|Window", text)
    if limit == "-1":
        assert "BroadcastHashJoin" not in text


def test_top_products_keep_n_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(E.queries()["top_products"](spark, SMALL))


def test_scans_read_only_what_is_used(spark):
    text = plan(E.queries()["product_metrics"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in text
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text
    volume = plan(E.queries()["top_products"](spark, SMALL))
    assert "l_extendedprice" not in volume


def test_validation_is_one_pass(spark):
    df = E.queries()["validation_report"](spark, SMALL)
    assert plan(df).count("FileScan") == 3  # lines, orders, customers once each


def test_plain_frame_is_validated_in_one_job(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    lines = spark.range(100).selectExpr("'a@b.co' AS email", "1F AS latitude", "2F AS longitude", "1 AS quantity")
    assert jobs_of(spark, lambda: V.rule_report(lines, V.sale_rules()).collect()) == 1


def test_distinct_orders_are_counted_on_a_spread_key_first(sales_of_rows):
    """The first exchange hashes (customer, order), so one customer's lines go to many tasks."""
    text = plan(customer_totals(sales_of_rows((1, 1, 1, 1, 1, "2023-01-01"))))
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert [len(re.findall("#", e)) for e in exchanges] == [1, 2]  # printed from the top down
    assert "partial_sum" in text


def test_hot_order_is_split_although_the_aggregate_uses_the_join_partitioning(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "50000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.shuffle.partitions", "16")
    from tillwise.sources.star import sales_lines

    lineitem = spark.range(0, 60000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 1, id % 5000) AS l_orderkey", "id AS l_partkey", "1D AS l_quantity", "2D AS l_extendedprice"
    )
    orders = spark.range(5000).selectExpr(
        "id AS o_orderkey", "id % 70 AS o_custkey", "timestamp_ntz'2023-01-01 00:00:00' AS o_orderdate"
    )
    totals = customer_totals(sales_lines(lineitem, orders))
    got = totals.agg(F.sum("total_revenue"), F.sum("total_orders")).first()
    distinct_orders = len({1 if i % 3 == 0 else i % 5000 for i in range(60000)})
    assert (int(got[0]), got[1]) == (120000, distinct_orders)
    totals.collect()
    assert "skew=true" in plan(totals)


def test_shuffles_start_sized_to_the_input_and_settings_come_back(spark, conf):
    conf("spark.sql.adaptive.enabled", "true")
    before = spark.conf.get(INITIAL, None)
    with prepared(spark, 100 * 2**40):
        text = plan(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count())
    assert "819200" in text and spark.conf.get(INITIAL, None) == before
    sized = scanned_bytes(spark.read.parquet(f"{SMALL}/lineitem.parquet"), spark.read.parquet(f"{SMALL}/orders.parquet"))
    assert sized == sum(os.path.getsize(f"{SMALL}/{n}.parquet") for n in ("lineitem", "orders"))


def test_job_reads_the_raw_sales_once(spark, sales_of_rows, customers_of_rows, weather_of_rows, tmp_path):
    """Later steps read what the first one has written."""
    sales_of_rows((1, 1, 1, 1, 10, "2023-01-01")).write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    customers = customers_of_rows((1, "n1", "u1", "u1@b.co", 1.0, 5.0))
    with staged(raw, "copy") as copy:
        assert "/raw" not in " ".join(copy.inputFiles())
    tables = run_job(spark, raw, customers, weather_of_rows(), f"{shared_folder(spark)}/job-{uuid.uuid4().hex}")
    assert tables["sales"].rows().count() == 1


def test_a_task_holds_a_bounded_part_of_a_shuffle_whatever_the_input(spark, conf):
    conf(MERGED, "64m")
    with prepared(spark):
        assert spark.conf.get(MERGED) == str(MERGED_BYTES)
    assert spark.conf.get(MERGED) == "64m"
    conf(MERGED, "1m")
    with prepared(spark):
        assert spark.conf.get(MERGED) == "1m"
