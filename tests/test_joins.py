"""Enrichment on small frames."""

from conftest import rows
from pyspark.sql import functions as F

from tillwise.operators.joins import (
    lookup_keys,
    orphans,
    seen_customers,
    with_customers,
    with_weather,
)
from tillwise.operators.merge import customers_of
from tillwise.plans.enrich import enrich, enrich_by_customer_day, enrich_lines
from tillwise.sources.files import flatten_users
from tillwise.staging import stage

ANN = (1, "Ann", "ann", "a@b.co", 10.5, 20.25)
BOB = (2, "Bob", "bob", "b@b.co", None, 1.0)


def test_text_ids_join_and_bad_ones_do_not_stop_the_job(spark, sales_of_rows):
    users = spark.createDataFrame(
        [(i, f"n{i}", f"u{i}", f"e{i}", ((lat, "2.5"),)) for i, lat in (("1", "1.5"), ("7", "x"), ("abc", "3"))],
        "id string, name string, username string, email string,"
        " address struct<geo: struct<lat: string, lng: string>>",
    )
    flat = flatten_users(users)
    assert rows(flat, "customer_id", "latitude", "longitude") == [
        (1, 1.5, 2.5), (7, None, 2.5), (None, 3.0, 2.5),
    ]
    sales = sales_of_rows((1, 1, 1, 1, 1, "2023-01-01"), (2, 7, 1, 1, 1, "2023-01-01"), (3, 9, 1, 1, 1, "2023-01-01"))
    assert rows(with_customers(sales, flat), "order_id", "username") == [(1, "u1"), (2, "u7"), (3, None)]


def test_both_enrichments_give_the_same_lines(sales_of_rows, customers_of_rows, weather_of_rows):
    sales = sales_of_rows(
        (1, 1, 1, 1, 1, "2023-01-01"),
        (1, 1, 2, 1, 1, "2023-01-01"),
        (2, 1, 1, 1, 1, "2023-01-02"),
        (3, 2, 1, 1, 1, "2023-01-01"),  # customer without a latitude
        (4, 9, 1, 1, 1, "2023-01-01"),  # unknown customer
        (5, None, 1, 1, 1, "2023-01-01"),
        (6, 1, 1, 1, 1, None),
    )
    customers = customers_of_rows(ANN, BOB)
    weather = weather_of_rows((10.5, 20.25, "2023-01-01", 3.5, "Snow"))
    direct = enrich_lines(sales, customers, weather)
    by_day = enrich_by_customer_day(sales, customers, weather)
    assert direct.columns == by_day.columns
    assert rows(direct) == rows(by_day) == rows(enrich(sales, customers, weather))
    assert rows(direct, "order_id", "product_id", "weather_condition") == [
        (1, 1, "Snow"), (1, 2, "Snow"), (2, 1, None), (3, 1, None), (4, 1, None), (5, 1, None), (6, 1, None),
    ]


def test_size_decides_which_enrichment_runs(spark, sales_of_rows, customers_of_rows, weather_of_rows, conf):
    sales = sales_of_rows((1, 1, 1, 1, 1, "2023-01-01"))
    # files have a known size, rows handed over by the driver have not
    customers = stage(customers_of_rows(ANN), "customers")
    weather = stage(weather_of_rows((10.5, 20.25, "2023-01-01", 3.5, "Snow")), "weather")
    plan = lambda: enrich(sales, customers, weather)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan()
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Aggregate" in plan()


def test_lookup_keys_are_distinct_and_complete(sales_of_rows, customers_of_rows):
    sales = sales_of_rows(
        (1, 1, 1, 1, 1, "2023-01-01"), (2, 1, 1, 1, 1, "2023-01-01"),
        (3, 2, 1, 1, 1, "2023-01-01"), (4, 9, 1, 1, 1, "2023-01-01"),
    )
    keys = lookup_keys(sales, customers_of_rows(ANN, BOB))
    assert [(a, b, str(d)) for a, b, d in rows(keys)] == [(10.5, 20.25, "2023-01-01")]


def test_nan_matches_itself_and_null_matches_nothing(sales_of_rows, customers_of_rows, weather_of_rows):
    nan = float("nan")
    sales = sales_of_rows((1, 1, 1, 1, 1, "2023-01-01"), (2, 2, 1, 1, 1, "2023-01-01"))
    lines = with_customers(sales, customers_of_rows((1, "n", "u", "e", nan, 0.0), (2, "n", "v", "f", None, 0.0)))
    weather = weather_of_rows((nan, -0.0, "2023-01-01", 1.0, "Rain"), (None, 0.0, "2023-01-01", 1.0, "Snow"))
    assert rows(with_weather(lines, weather), "order_id", "weather_condition") == [(1, "Rain"), (2, None)]


def test_seen_customers_equal_the_distinct_ones_of_the_lines(sales_of_rows, customers_of_rows):
    sales = sales_of_rows(*[(i, c, 1, 1, 1, "2023-01-01") for i, c in enumerate((1, 1, 2, 9, None))])
    customers = customers_of_rows(ANN, BOB, (3, "Cid", "cid", "c@b.co", 1.0, 1.0))
    lines = with_customers(sales, customers)
    assert rows(seen_customers(sales, customers)) == rows(customers_of(lines))


def test_orphans_count_lines_per_missing_parent(spark, sales_of_rows, customers_of_rows):
    sales = sales_of_rows(
        (1, 1, 1, 1, 1, "2023-01-01"), (2, 9, 1, 1, 1, "2023-01-01"),
        (3, 9, 2, 1, 1, "2023-01-01"), (4, None, 1, 1, 1, "2023-01-01"),
    )
    assert rows(orphans(sales, "customer_id", customers_of_rows(ANN), "customer_id")) == [(9, 2)]


def test_hot_customer_is_split_in_the_merge_join(spark, conf):
    """A third of all lines belong to one customer; adaptive execution splits its partition."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "50000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.shuffle.partitions", "16")
    n = 60000
    sales = spark.range(0, n, 1, 8).selectExpr(
        "id AS order_id", "IF(id % 3 = 0, 1, id) AS customer_id", "id AS product_id",
        "1 AS quantity", "CAST(1 AS DECIMAL(18,2)) AS price", "date'2023-01-01' AS order_date",
    )
    customers = spark.range(n).selectExpr("id AS customer_id", "string(id) AS name")
    joined = with_customers(sales, customers)
    joined.write.format("noop").mode("overwrite").save()
    counted = joined.groupBy("order_id").agg(F.count("name").alias("n"))
    assert counted.agg(F.sum("n")).first()[0] == n
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
