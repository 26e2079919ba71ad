"""The whole job on generated files, with known answers."""

import json
import sys
import uuid
from decimal import Decimal

import pytest
from conftest import day, rows
from pyspark import cloudpickle

from tillwise import contracts as C
from tillwise.operators.validate import ValidationError
from tillwise.plans.job import open_tables, row_counts, run_job, run_job_on_files
from tillwise.staging import shared_folder

# executors cannot import this file, so its functions travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLES = [
    "customer_metrics", "customers", "monthly_sales_metrics", "product_metrics", "sales", "seasonal_sales_metrics",
]

# four customers, the first order of each on 1 January, revenue 40, 80, 120 and 160 over 40 days
LINES = [
    (10 * c + n, c, 1 + n, n + 1, Decimal(c * 20), d)
    for c in range(1, 5)
    for n, d in enumerate(["2023-01-01", "2023-02-10"])
]


def document(latitude, longitude, epoch):
    return json.dumps({"data": [{"temp": latitude, "weather": [{"main": "Rain" if latitude < 3 else "Snow"}]}]})


def some_days(latitude, longitude, epoch):
    return None if epoch == 1672531200 else document(latitude, longitude, epoch)


@pytest.fixture
def files(tmp_path):
    head = "order_id,customer_id,product_id,quantity,price,order_date\n"
    (tmp_path / "sales.csv").write_text(head + "\n".join(",".join(map(str, r)) for r in LINES))
    users = [
        {"id": c, "name": f"n{c}", "username": f"u{c}", "email": f"u{c}@b.co", "address": {"geo": {"lat": str(c), "lng": "5"}}}
        for c in range(1, 5)
    ]
    (tmp_path / "users.json").write_text(json.dumps(users))
    return str(tmp_path / "sales.csv"), str(tmp_path / "users.json")


@pytest.fixture
def folder(spark):
    return f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"


def test_known_answers_and_rerun(spark, files, folder, weather_of_rows):
    tables = run_job_on_files(spark, *files, weather_of_rows(), folder, fetch=some_days)
    assert sorted(tables) == TABLES
    assert rows(tables["customer_metrics"].rows()) == [
        (c, Decimal(c), segment, 0, 2, Decimal(40 * c))
        for c, segment in zip(range(1, 5), ("Low", "Medium", "High", "Very High"))
    ]
    assert rows(tables["product_metrics"].rows()) == [(1, 4, Decimal(200), 1), (2, 8, Decimal(200), 2)]
    assert rows(tables["monthly_sales_metrics"].rows()) == [
        ("2023-01", 4, Decimal(200), 1, 4), ("2023-02", 8, Decimal(200), 2, 4),
    ]
    assert rows(tables["seasonal_sales_metrics"].rows()) == [
        ("Rain", 4, Decimal(60), 2, 2), ("Snow", 4, Decimal(140), 2, 2), ("Unknown", 4, Decimal(200), 1, 4),
    ]
    assert rows(tables["sales"].rows(), "order_id", "weather_condition")[:2] == [(10, None), (11, "Rain")]
    before = {name: rows(t.rows()) for name, t in tables.items()}
    again = run_job_on_files(spark, *files, weather_of_rows(), folder, fetch=some_days)
    assert {name: rows(t.rows()) for name, t in again.items()} == before
    assert dict(rows(row_counts(open_tables(spark, folder)))) == {n: len(r) for n, r in before.items()}


@pytest.mark.parametrize("mode", ["upsert", "insert_if_absent"])
def test_second_batch(spark, folder, sales_of_rows, customers_of_rows, weather_of_rows, mode):
    customers = customers_of_rows((1, "n1", "u1", "u1@b.co", 1.0, 5.0), (2, "n2", "u2", "u2@b.co", 2.0, 5.0))
    weather = weather_of_rows((1.0, 5.0, "2023-01-01", 4.0, "Rain"))
    first = sales_of_rows((1, 1, 1, 1, 10, "2023-01-01"))
    second = sales_of_rows((1, 1, 1, 9, 99, "2023-01-01"), (2, 2, 1, 2, 20, "2023-01-02"))
    run_job(spark, first, customers, weather, folder)
    tables = run_job(spark, second, customers, weather, folder, metrics_mode=mode, metrics_of="batch")
    assert rows(tables["sales"].rows(), "order_id", "quantity") == [(1, 1), (2, 2)]
    assert rows(tables["customers"].rows(), "username") == [("u1",), ("u2",)]
    volume = {"upsert": 11, "insert_if_absent": 1}[mode]
    assert rows(tables["product_metrics"].rows(), "product_id", "sales_volume") == [(1, volume)]


def test_metrics_describe_the_merged_table(spark, folder, sales_of_rows, customers_of_rows, weather_of_rows):
    customers = customers_of_rows((1, "n1", "u1", "u1@b.co", 1.0, 5.0))
    run_job(spark, sales_of_rows((1, 1, 1, 1, 10, "2022-06-01")), customers, weather_of_rows(), folder)
    second = sales_of_rows((1, 1, 1, 9, 99, "2022-06-01"), (2, 1, 1, 2, 20, "2022-07-02"), (2, 1, 1, 2, 20, "2022-07-02"))
    tables = run_job(spark, second, customers, weather_of_rows(), folder)
    assert rows(tables["monthly_sales_metrics"].rows(), "year_month", "total_sales_volume") == [("2022-06", 1), ("2022-07", 2)]
    for name, column in (
        ("monthly_sales_metrics", "total_sales_revenue"), ("seasonal_sales_metrics", "total_sales_revenue"),
        ("product_metrics", "total_revenue"), ("customer_metrics", "total_revenue"), ("sales", "price"),
    ):
        assert tables[name].rows().selectExpr(f"sum({column})").first()[0] == 30, name


def test_clash_with_held_rows_changes_nothing(spark, folder, sales_of_rows, customers_of_rows, weather_of_rows):
    run_job(
        spark, sales_of_rows((1, 1, 1, 1, 10, "2023-01-01")),
        customers_of_rows((1, "n1", "u1", "u1@b.co", 1.0, 5.0)), weather_of_rows(), folder,
    )
    second = customers_of_rows((1, "n1", "u1b", "u1@b.co", 1.0, 5.0), (9, "n9", "u1", "u9@b.co", 1.0, 5.0))
    sales = sales_of_rows((2, 1, 1, 1, 10, "2023-01-02"), (3, 9, 1, 1, 10, "2023-01-02"))
    with pytest.raises(ValidationError) as stopped:
        run_job(spark, sales, second, weather_of_rows(), folder)
    assert str(stopped.value) == "customer_id_reference: 1, customer_id_unique: 1, email_unique: 1"
    tables = open_tables(spark, folder)
    assert rows(tables["customers"].rows(), "username") == [("u1",)]
    assert rows(tables["sales"].rows(), "order_id") == [(1,)]


def test_large_ids_and_prices_are_loaded(spark, folder, sales_of_rows, customers_of_rows, weather_of_rows):
    sales = sales_of_rows((3_000_000_000, 1, 1, 1, "250000000.00", "2023-01-01"))
    customers = customers_of_rows((1, "n1", "u1", "u1@b.co", 1.0, 5.0))
    tables = run_job(spark, sales, customers, weather_of_rows(), folder)
    assert rows(tables["sales"].rows(), "order_id", "price") == [(3_000_000_000, Decimal("250000000.00"))]
    assert rows(tables["product_metrics"].rows(), "total_revenue") == [(Decimal("250000000.00"),)]


def refuse(latitude, longitude, epoch):
    problem = OSError("not again")
    problem.permanent = True
    raise problem


def test_second_run_asks_for_nothing_and_failures_are_written(spark, files, folder, weather_of_rows):
    run_job_on_files(spark, *files, weather_of_rows(), folder, fetch=some_days)
    before = rows(open_tables(spark, folder)["seasonal_sales_metrics"].rows())
    run_job_on_files(spark, *files, weather_of_rows(), folder, fetch=refuse)
    assert rows(open_tables(spark, folder)["seasonal_sales_metrics"].rows()) == before
    assert spark.read.parquet(f"{folder}/failed_lookups").count() == 0
    other = f"{folder}-other"
    run_job_on_files(spark, *files, weather_of_rows(), other, fetch=refuse, lookup_options={"on_error": "skip"})
    failed = spark.read.parquet(f"{other}/failed_lookups")
    assert failed.count() == 8 and set(rows(failed, "error")) == {("OSError: not again",)}


def test_patterns_and_user_lines(spark, files, folder, weather_of_rows, tmp_path):
    users = json.loads((tmp_path / "users.json").read_text())
    (tmp_path / "users.jsonl").write_text("\n".join(map(json.dumps, users)))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    tables = run_job_on_files(
        spark, str(tmp_path / "*.csv"), str(tmp_path / "users.jsonl"), weather_of_rows(), folder, user_lines=True
    )
    assert tables["customers"].rows().count() == 4 and tables["sales"].rows().count() == 8
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) == before


def test_rejected_rows_are_added_once(spark, folder, sales_of_rows, customers_of_rows, weather_of_rows):
    customers = customers_of_rows((1, "n1", "u1", "u1@b.co", 1.0, 5.0))
    sales = sales_of_rows((1, 1, 1, 1, 10, "2023-01-01"), (2, 1, 1, 0, 10, "2023-01-01"))
    for _ in range(2):
        run_job(spark, sales, customers, weather_of_rows(), folder, bad_rows="quarantine")
    assert spark.read.parquet(f"{folder}/rejected_sales").count() == 1


def test_unknown_customer_stops_the_job_or_is_set_aside(spark, folder, sales_of_rows, customers_of_rows, weather_of_rows):
    customers = customers_of_rows((1, "n1", "u1", "u1@b.co", 1.0, 5.0), (2, "n2", "u2", "broken", 2.0, 5.0))
    sales = sales_of_rows(
        (1, 1, 1, 1, 10, "2023-01-01"), (2, 9, 1, 1, 10, "2023-01-01"),
        (3, 1, 1, 0, 10, "2023-01-02"), (4, 2, 1, 1, 10, "2023-01-02"),
    )
    with pytest.raises(ValidationError) as stopped:
        run_job(spark, sales, customers, weather_of_rows(), folder)
    assert str(stopped.value) == (
        "email_format: 1, email_not_null: 1, name_not_null: 1, quantity_positive: 1, username_not_null: 1"
    )
    assert set(dict(rows(row_counts(open_tables(spark, folder)))).values()) == {0}
    tables = run_job(spark, sales, customers, weather_of_rows(), folder, bad_rows="quarantine")
    assert rows(tables["sales"].rows(), "order_id") == [(1,)]
    rejected = spark.read.parquet(f"{folder}/rejected_sales")
    assert rows(rejected, "order_id", "broken_rules") == [
        (2, ["name_not_null", "username_not_null", "email_not_null"]),
        (3, ["quantity_positive"]),
        (4, ["email_format"]),
    ]


def test_wrong_schema_stops_before_any_load(spark, folder, sales_of_rows, customers_of_rows, weather_of_rows):
    sales = sales_of_rows((1, 1, 1, 1, 10, "2023-01-01"))
    sales = sales.withColumn("quantity", sales.quantity.cast("string"))
    customers = customers_of_rows((1, "n1", "u1", "u1@b.co", 1.0, 5.0))
    with pytest.raises(ValidationError, match="column quantity is string"):
        run_job(spark, sales, customers, weather_of_rows(), folder)


def test_conflict_on_another_unique_key_is_reported(spark, folder, sales_of_rows, customers_of_rows, weather_of_rows):
    customers = customers_of_rows((1, "n1", "u1", "same@b.co", 1.0, 5.0), (2, "n2", "u2", "same@b.co", 2.0, 5.0))
    sales = sales_of_rows((1, 1, 1, 1, 10, "2023-01-01"), (2, 2, 1, 1, 10, "2023-01-01"))
    with pytest.raises(ValidationError, match="email_unique: 1"):
        run_job(spark, sales, customers, weather_of_rows(), folder)


def test_sales_table_prunes_months(spark, folder, files, weather_of_rows):
    tables = run_job_on_files(spark, *files, weather_of_rows(), folder)
    january = tables["sales"].read().where("order_month = '2023-01'")
    assert {r["order_date"] for r in january.collect()} == {day("2023-01-01")}
    assert january.select(*C.SALES_TABLE.names).schema == C.SALES_TABLE.schema
