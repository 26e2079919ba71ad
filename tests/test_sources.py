"""Files, documents and the keyed lookup."""

import json
import sys
import uuid
from decimal import Decimal
from types import SimpleNamespace

import pytest
from conftest import day, rows
from pyspark import cloudpickle

from tillwise import contracts as C
from tillwise.functions.columns import epoch_seconds
from tillwise.session import PARTITION_BYTES, input_bytes, size_shuffles
from tillwise.sinks.tables import ParquetTable
from tillwise.sources import lookup as L
from tillwise.sources.documents import json_field, parse_weather
from tillwise.sources.files import (
    frame_of,
    parse_users,
    read_sales_csv,
    read_sales_csv_checked,
    read_users_json,
)
from tillwise.staging import shared_folder

# executors cannot import this file, so its functions travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CSV = """order_id,customer_id,product_id,quantity,price,order_date
71,4,12,2,18.9,2024-03-05
72,9,31,5,7.25,not a date
73,x,8,6,12.345,2024-11-30
"""

USERS = [
    {"id": 1, "name": "A", "username": "a", "email": "a@b.co", "address": {"city": "C", "geo": {"lat": "-37.31", "lng": "81.5"}}},
    {"id": 2, "name": "B", "username": "b", "email": "b@b.co", "address": {}},
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sales_csv(spark, tmp_path, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    path = tmp_path / "sales.csv"
    path.write_text(CSV)
    df = read_sales_csv(spark, str(path))
    assert df.schema["price"].dataType == C.MONEY
    assert rows(df) == [
        (71, 4, 12, 2, Decimal("18.90"), day("2024-03-05")),
        (72, 9, 31, 5, Decimal("7.25"), None),
        (73, None, 8, 6, Decimal("12.35"), day("2024-11-30")),
    ]


def test_unreadable_lines_are_set_aside_with_their_reasons(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(
        "note,order_id,customer_id,product_id,quantity,price,order_date\n"
        "a,71,4,12,2,18.9,2024-03-05\n"
        "b,72,9,31,5,7.25,not a date\n"
        '"c, d",73,x,8,six,12.345,2024-11-30\n'
        "e,74,,8,,,\n"
        "f,75,1,8,3\n"
        "g,76,1,8,3,1.5,2024-02-30,more\n"
    )
    good, rejected = read_sales_csv_checked(spark, str(path))
    assert good.schema == read_sales_csv(spark, str(path)).schema
    assert rows(good) == [(71, 4, 12, 2, Decimal("18.90"), day("2024-03-05")), (74, None, 8, None, None, None)]
    assert rows(rejected) == [
        ('"c, d",73,x,8,six,12.345,2024-11-30', ["customer_id", "quantity"]),
        ("b,72,9,31,5,7.25,not a date", ["order_date"]),
        ("f,75,1,8,3", ["fields"]),
        ("g,76,1,8,3,1.5,2024-02-30,more", ["order_date"]),
    ]
    assert good.count() == 2 and rejected.count() == 4


def test_sales_csv_goes_by_the_header(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("customer_id,note,order_id,price,product_id,order_date,quantity\n4,n,71,18.9,12,2024-03-05,2\n")
    df = read_sales_csv(spark, str(path))
    assert df.columns == C.SALES_CSV.names
    assert rows(df) == [(71, 4, 12, 2, Decimal("18.90"), day("2024-03-05"))]
    path.write_text("customer_id,order_id,price\n4,71,18.9\n")
    with pytest.raises(ValueError, match="no column product_id, quantity, order_date"):
        read_sales_csv(spark, str(path))


def test_sales_csv_with_inferred_types(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(CSV.replace("not a date", "2024-07-01").replace("x", "6"))
    df = read_sales_csv(spark, str(path), infer=True)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "int", "int", "int", "double", "date"]
    assert df.count() == 3


def test_user_documents_from_array_file_lines_and_column(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps(USERS, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(u) for u in USERS))
    texts = spark.createDataFrame([(json.dumps(u),) for u in USERS], "doc string")
    want = [(1, "A", "a", "a@b.co", pytest.approx(-37.31, abs=1e-5), 81.5), (2, "B", "b", "b@b.co", None, None)]
    for df in (
        read_users_json(spark, str(tmp_path / "array.json")),
        read_users_json(spark, str(tmp_path / "lines.json"), multi_line=False),
        parse_users(texts, "doc"),
    ):
        assert df.schema == C.CUSTOMERS.schema
        assert rows(df) == want


def test_local_rows_take_the_contract_schema(spark):
    assert frame_of(spark, [(1, "n", "u", "e", 1.0, 2.0)], C.CUSTOMERS).schema == C.CUSTOMERS.schema
    assert frame_of(spark, [], C.WEATHER).schema == C.WEATHER.schema


def test_weather_document_paths(spark):
    documents = [
        '{"data": [{"temp": 3.5, "weather": [{"main": "Rain"}, {"main": "Snow"}]}, {"temp": 9}]}',
        '{"data": [{"temp": 1, "weather": []}]}',
        '{"data": []}', "{}", "not json", None,
    ]
    df = spark.createDataFrame(list(enumerate(documents)), "id int, doc string")
    assert rows(parse_weather(df, "doc")) == [
        (0, 3.5, "Rain"), (1, 1.0, None), (2, None, None), (3, None, None), (4, None, None), (5, None, None),
    ]


def test_json_field(spark):
    df = spark.createDataFrame([('{"k": 7}',), ('{"k": "x"}',), ("{}",), ("bad",)], "p string")
    assert rows(df.select(json_field("p", "k", "bigint").alias("k"))) == [(7,), (None,), (None,), (None,)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_is_utc_midnight_in_any_session_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    df = spark.sql("SELECT date'2023-03-12' AS d").select(epoch_seconds("d").alias("e"))
    assert df.first()["e"] == 1678579200


# ------------------------------------------------------------------------ lookup


@pytest.fixture
def keys(spark):
    def make(*points):
        typed = [(a, b, None if d is None else day(d)) for a, b, d in points]
        return spark.createDataFrame(typed, "latitude float, longitude float, order_date date")

    return make


def answer(condition="Rain", temp=1.5):
    return json.dumps({"data": [{"temp": temp, "weather": [{"main": condition}]}]})


def test_answers_are_added_and_a_second_run_writes_nothing(spark, tmp_path, keys, weather_of_rows):
    table = ParquetTable(spark, f"{shared_folder(spark)}/weather-{uuid.uuid4().hex}", C.WEATHER, by_month="order_date")
    fetch = counting_fetch(str(tmp_path), lambda latitude, _: answer() if latitude < 3 else None)
    first, second = keys((1.0, 1.0, "2023-01-01"), (3.0, 1.0, "2023-01-02")), keys((1.0, 1.0, "2023-01-01"), (2.0, 1.0, "2023-03-01"))
    for wanted, size, version in ((first, 2, 1), (second, 3, 2), (second, 3, 2), (first.unionByName(second), 3, 2)):
        found, failed = L.look_up_into(table, wanted, weather_of_rows(), fetch, partitions=2)
        assert (table.rows().count(), table.version(), failed.count()) == (size, version, 0)
    assert rows(found, "latitude", "weather_condition") == [(1.0, "Rain"), (2.0, "Rain"), (3.0, None)]
    assert {p.month for p in table.manifest().parts if p.load.startswith("load=00000002")} == {"2023-03"}
    assert len(list(tmp_path.iterdir())) == 3


def counting_fetch(folder, reply):
    """A service that leaves one file per call, so that calls in tasks can be counted."""

    def fetch(latitude, longitude, epoch):
        import pathlib
        import uuid as u

        calls = pathlib.Path(folder)
        seen = len(list(calls.glob(f"{latitude}-*")))
        (calls / f"{latitude}-{u.uuid4().hex}").write_text(str(epoch))
        return reply(latitude, seen)

    return fetch


def calls(folder, latitude):
    return len(list(folder.glob(f"{latitude}-*")))


def test_only_missing_complete_keys_are_asked_once(tmp_path, keys, weather_of_rows):
    wanted = keys((1.0, 1.0, "2023-01-01"), (1.0, 1.0, "2023-01-01"), (2.0, 1.0, "2023-01-01"), (3.0, None, "2023-01-01"))
    known = weather_of_rows((2.0, 1.0, "2023-01-01", 9.0, "Snow"))
    found = L.look_up(wanted, known, counting_fetch(str(tmp_path), lambda *_: answer()), partitions=2)
    want = [(1.0, 1.0, day("2023-01-01"), 1.5, "Rain"), (2.0, 1.0, day("2023-01-01"), 9.0, "Snow")]
    assert rows(found) == rows(found) == want
    assert [calls(tmp_path, x) for x in (1.0, 2.0, 3.0)] == [1, 0, 0]
    assert next(tmp_path.glob("1.0-*")).read_text() == "1672531200"


def test_retry_then_answer_empty_and_failure_are_told_apart(tmp_path, keys):
    def reply(latitude, seen):
        if latitude == 1.0 and seen < 2:
            raise ConnectionError("busy")
        if latitude == 2.0:
            return None
        if latitude == 3.0:
            raise ConnectionError("down")
        if latitude == 4.0:
            problem = ValueError("refused")
            problem.permanent = True
            raise problem
        return answer()

    wanted = keys(*[(float(i), 0.0, "2023-01-01") for i in range(1, 6)])
    outcomes = L.fetch_documents(
        wanted, counting_fetch(str(tmp_path), reply), partitions=2, first_wait=0.001, on_error="skip"
    )
    got = {r["latitude"]: (r["status"], r["error"]) for r in outcomes.collect()}
    assert got == {
        1.0: ("ok", None), 2.0: ("empty", None), 3.0: ("failed", "ConnectionError: down"),
        4.0: ("failed", "ValueError: refused"), 5.0: ("ok", None),
    }
    assert [calls(tmp_path, float(i)) for i in range(1, 6)] == [3, 1, L.ATTEMPTS, 1, 1]


def test_time_limit_ends_the_retries(tmp_path, keys):
    def reply(latitude, seen):
        raise ConnectionError("down")

    outcomes = L.fetch_documents(
        keys((1.0, 0.0, "2023-01-01")), counting_fetch(str(tmp_path), reply), max_seconds=0.0, on_error="skip"
    )
    assert outcomes.first()["status"] == "failed"
    assert calls(tmp_path, 1.0) == 1


def test_failure_stops_the_job_by_default(tmp_path, keys):
    def reply(latitude, seen):
        raise ConnectionError("down for good")

    fetch = counting_fetch(str(tmp_path), reply)
    with pytest.raises(Exception, match="down for good"):
        L.fetch_documents(keys((1.0, 0.0, "2023-01-01")), fetch, attempts=2, first_wait=0.001).collect()
    with pytest.raises(ValueError):
        L.fetch_documents(keys((1.0, 0.0, "2023-01-01")), fetch, on_error="maybe")


def test_answer_without_a_condition_keeps_its_key(keys, weather_of_rows):
    found = L.look_up(keys((1.0, 1.0, "2023-01-01")), weather_of_rows(), lambda *_: '{"data": []}')
    assert rows(found, "latitude", "temperature", "weather_condition") == [(1.0, None, None)]


# ------------------------------------------------------------------ shared folder


def test_shuffle_size_follows_the_input(spark, conf, tmp_path):
    conf("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4")
    (tmp_path / "a").write_text("x" * 1000)
    assert input_bytes(spark, str(tmp_path)) >= 1000
    assert size_shuffles(spark, 1) == 4
    assert size_shuffles(spark, 100 * PARTITION_BYTES) == 100
    assert size_shuffles(spark, 100 * 2**40) == 819200


def session_with(master, **conf):
    made = []
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: made[-1] if made else None,
        setCheckpointDir=made.append,
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context)


def test_shared_folder_is_the_one_the_session_names(spark):
    named = session_with("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://shared/x/"})
    assert shared_folder(named) == "hdfs://shared/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session_with("spark://host:7077"))
    local = session_with("local[2]")
    assert shared_folder(local) == shared_folder(local)
    assert shared_folder(spark)
