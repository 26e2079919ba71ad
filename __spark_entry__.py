"""Queries over the given tables, and the same answers in SQL.

``queries()`` and ``oracle_sql()`` share names and column names. Every query runs
over whole tables. Sales lines are ``lineitem`` joined to ``orders``, customers
come from ``customer``; the weather of a place and day follows a fixed rule.
"""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import contracts as C
from tillwise.functions.columns import epoch_seconds
from tillwise.operators import metrics as M
from tillwise.operators import reports as R
from tillwise.operators import validate as V
from tillwise.operators.aggregates import duplicate_keys
from tillwise.operators.conform import conform
from tillwise.operators.joins import (
    lookup_keys,
    orphans,
    seen_customers,
    with_customers,
    with_weather,
)
from tillwise.operators.merge import (
    first_per_key,
    insert_if_absent,
    merge_counts,
    rows_to_insert,
    upsert,
    without_key,
)
from tillwise.operators.spreads import price_quantiles, price_spreads
from tillwise.operators.totals import measured_lines, merged
from tillwise.plans.enrich import enrich, enrich_by_customer_day
from tillwise.plans.job import row_counts, run_job
from tillwise.session import AS_ROWS, input_bytes, prepare
from tillwise.sinks.tables import ParquetTable
from tillwise.sources.documents import json_field
from tillwise.sources.files import flatten_users, parse_users, read_sales_csv, read_sales_csv_checked, read_users_json
from tillwise.sources.lookup import fetch_documents, look_up, outcome_counts
from tillwise.sources.star import order_heads, sales_lines, star_table
from tillwise.staging import fits_broadcast, shared_folder, stage

SMOKE = "/root/testdata/sf0.001"

# ------------------------------------------------------------------- test tables


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark, AS_ROWS * input_bytes(spark, f"{folder}/lineitem.parquet", f"{folder}/orders.parquet"))
    return sales_lines(star_table(spark, folder, "lineitem"), star_table(spark, folder, "orders"))


def _user_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The customer table in the shape of user documents.

    Every 97th address is broken, so that the email rule has something to find.
    """
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    email = F.when(key % 97 == 0, F.concat(F.lit("c"), key, F.lit(".example"))).otherwise(
        F.concat(F.lit("c"), key, F.lit("@example.com"))
    )
    geo = F.struct(
        (nation * 7 - 85).cast("string").alias("lat"),
        (nation * 14 - 170).cast("string").alias("lng"),
    )
    return star_table(spark, folder, "customer").select(
        key.cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_name").alias("username"),
        email.alias("email"),
        F.struct(geo.alias("geo")).alias("address"),
    )


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return flatten_users(_user_documents(spark, folder))


def _weather_rule(keys: DataFrame) -> DataFrame:
    """The weather of each place and day; a day in eleven has none."""
    nation = ((F.col("latitude") + 85) / 7).cast("int")
    day = F.dayofyear("order_date")
    conditions = F.array(*[F.lit(c) for c in ("Clear", "Clouds", "Rain", "Snow")])
    return keys.where((nation + day) % 11 != 0).select(
        "latitude",
        "longitude",
        "order_date",
        (((nation * 13 + day) % 500) / 10 - 10).cast("float").alias("temperature"),
        F.get(conditions, (nation * 7 + day) % 4).alias("weather_condition"),
    )


def _weather(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup table, written once: answers for every place and day with an order.

    Customer and day come from the orders alone, so the lines are not read for it.
    """
    days = order_heads(star_table(spark, folder, "orders"))
    return stage(_weather_rule(lookup_keys(days, _customers(spark, folder))), "weather")


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(_sales(spark, folder), _customers(spark, folder), _weather(spark, folder))


def _fetch_rule() -> Callable[[float, float, int], str | None]:
    """The same rule as a service that answers with a JSON document."""

    def fetch(latitude: float, longitude: float, epoch: int) -> str | None:
        import datetime
        import json

        day = datetime.datetime.fromtimestamp(epoch, datetime.timezone.utc).timetuple().tm_yday
        nation = int((latitude + 85) / 7)
        if (nation + day) % 11 == 0:
            return None
        condition = ("Clear", "Clouds", "Rain", "Snow")[(nation * 7 + day) % 4]
        temperature = ((nation * 13 + day) % 500) / 10 - 10
        return json.dumps({"data": [{"temp": temperature, "weather": [{"main": condition}]}]})

    return fetch


def _new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


# ----------------------------------------------------------------------- queries


def sales_fact(spark, folder):
    return _sales(spark, folder)


def customer_metrics(spark, folder):
    return M.customer_metrics(_sales(spark, folder))


def customer_metrics_approx(spark, folder):
    return M.customer_metrics(_sales(spark, folder), mode="approx")


def ltv_quantiles(spark, folder):
    totals = stage(M.customer_totals(_sales(spark, folder)), "customer-totals")
    values = M.customer_values(totals, M.latest_order_date(totals))
    cuts = M.value_cuts(values)
    return spark.createDataFrame(list(zip(M.QUARTILES, cuts)), "probability double, value double")


def product_metrics(spark, folder):
    return M.product_metrics(_sales(spark, folder))


def monthly_sales_metrics(spark, folder):
    return M.monthly_sales_metrics(_sales(spark, folder))


def seasonal_sales_metrics(spark, folder):
    return M.seasonal_sales_metrics(_enriched(spark, folder))


def enrich_customer(spark, folder):
    return with_customers(_sales(spark, folder), _customers(spark, folder))


def lookup_keys_query(spark, folder):
    return lookup_keys(_sales(spark, folder), _customers(spark, folder))


def enrich_weather(spark, folder):
    lines = with_customers(_sales(spark, folder), _customers(spark, folder))
    return with_weather(lines, _weather(spark, folder)).select(
        "order_id", "product_id", "quantity", "price",
        "latitude", "longitude", "order_date", "temperature", "weather_condition",
    )


def enriched_sales(spark, folder):
    return enrich_by_customer_day(
        _sales(spark, folder), _customers(spark, folder), _weather(spark, folder)
    )


def lookup_missing(spark, folder):
    """Answers before 1998 are known, the later ones are fetched as documents."""
    keys = lookup_keys(_sales(spark, folder), _customers(spark, folder))
    known = _weather_rule(keys.where(F.col("order_date") < "1998-01-01"))
    return look_up(keys, known, _fetch_rule(), partitions=32)


def date_epoch(spark, folder):
    orders = star_table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date")
    ).withColumn("epoch", epoch_seconds("order_date"))


def json_flatten(spark, folder):
    return star_table(spark, folder, "events").select(
        "event_id", json_field("props", "k", "bigint").alias("k")
    )


def flatten_user_documents(spark, folder):
    """Customers written as JSON text and read back from it."""
    texts = _user_documents(spark, folder).select(
        F.to_json(F.struct("id", "name", "username", "email", "address")).alias("document")
    )
    return parse_users(texts, "document")


def user_file(spark, folder):
    """User documents through a JSON-lines file in the shared folder."""
    path = _new_folder(spark, "users-json")
    _user_documents(spark, folder).write.json(path)
    return read_users_json(spark, path, multi_line=False)


def sales_csv(spark, folder):
    """Sales lines through CSV files in the shared folder, their columns in another order."""
    path = _new_folder(spark, "sales-csv")
    lines = _sales(spark, folder)
    lines.select(*reversed(lines.columns), F.lit("x").alias("note")).write.csv(path, header=True)
    return read_sales_csv(spark, path)


def unreadable_lines(spark, folder):
    """What is set aside of CSV files where some quantities are words and some dates no days."""
    path = _new_folder(spark, "sales-csv")
    order = F.col("order_id")
    _sales(spark, folder).select(
        "order_id",
        "customer_id",
        "product_id",
        F.when(order % 50 == 0, "many").otherwise(F.col("quantity").cast("string")).alias("quantity"),
        "price",
        F.when(order % 70 == 0, "1997-13-45").otherwise(F.col("order_date").cast("string")).alias("order_date"),
    ).write.csv(path, header=True)
    good, rejected = read_sales_csv_checked(spark, path)
    read = good.groupBy().agg(F.count(F.lit(1)).alias("lines")).select(
        F.lit("").alias("line"), F.lit("read").alias("reasons"), "lines"
    )
    return rejected.groupBy("line", F.array_join("reasons", ",").alias("reasons")).agg(
        F.count(F.lit(1)).alias("lines")
    ).unionByName(read)


def validation_report(spark, folder):
    lines = with_customers(_sales(spark, folder), _customers(spark, folder))
    return V.rule_report(lines, V.sale_rules())


def _sales_rows(spark, folder):
    return _enriched(spark, folder).select(*C.SALES_TABLE.names)


def constraint_report(spark, folder):
    rows = stage(_sales_rows(spark, folder), "sales-rows")
    return V.constraint_report(rows, C.SALES_TABLE, {"customers": _customers(spark, folder)})


def customer_constraint_report(spark, folder):
    return V.constraint_report(_customers(spark, folder), C.CUSTOMERS)


def invalid_lines(spark, folder):
    lines = with_customers(_sales(spark, folder), _customers(spark, folder))
    return V.offending_rows(lines, V.sale_rules()).select(
        "order_id", "product_id", "customer_id", "quantity", "price", "email",
        F.array_join("broken_rules", ",").alias("broken_rules"),
    )


def key_duplicates(spark, folder):
    return duplicate_keys(_sales(spark, folder), ["order_id", "product_id"])


def orphan_customers(spark, folder):
    """Customer ids of sales lines without a customer that has a positive balance."""
    solvent = star_table(spark, folder, "customer").where("c_acctbal > 0")
    return orphans(_sales(spark, folder), "customer_id", solvent, "c_custkey")


def _held_sales(spark, folder):
    """One line per key of the orders before July 1998."""
    lines = _sales(spark, folder).where(F.col("order_date") < "1998-07-01")
    return first_per_key(lines, ["order_id", "product_id"])


def _redelivered_sales(spark, folder):
    """All lines again, one dearer each, so that a replaced row would show."""
    dearer = (F.col("price") + F.lit(1)).cast(C.MONEY)
    return _sales(spark, folder).withColumn("price", dearer)


def merge_sales(spark, folder):
    return insert_if_absent(
        _held_sales(spark, folder), _redelivered_sales(spark, folder), ["order_id", "product_id"]
    )


def merge_sales_counts(spark, folder):
    return merge_counts(
        _held_sales(spark, folder), _redelivered_sales(spark, folder), ["order_id", "product_id"]
    )


def upsert_sales(spark, folder):
    late = _redelivered_sales(spark, folder).where(F.col("order_date") >= "1997-01-01")
    return upsert(_held_sales(spark, folder), late, ["order_id", "product_id"])


def merge_customers(spark, folder):
    """Customers of one market segment are held under an older address."""
    held = (
        _customers(spark, folder)
        .join(
            star_table(spark, folder, "customer")
            .where("c_mktsegment = 'BUILDING'")
            .select(F.col("c_custkey").alias("customer_id")),
            "customer_id",
            "left_semi",
        )
        .withColumn("email", F.concat(F.lit("old."), "email"))
    )
    seen = seen_customers(_sales(spark, folder), _customers(spark, folder))
    return insert_if_absent(held, seen, ["username"])


def staged_load(spark, folder):
    """Two batches staged, checked and merged into a table by month, read back."""
    table = ParquetTable(spark, _new_folder(spark, "sales"), C.SALES_TABLE, by_month="order_date")
    rows = stage(_sales_rows(spark, folder), "sales-rows")
    key = ["order_id", "product_id"]
    table.load(rows.where(F.col("order_date") < "1998-07-01"), key)
    dearer = (F.col("price") + F.lit(1)).cast(C.MONEY)
    table.load(rows.withColumn("price", dearer), key)
    return table.rows()


def upsert_table(spark, folder):
    """A table by month whose later months are replaced by key, read back."""
    table = ParquetTable(spark, _new_folder(spark, "sales"), C.SALES_TABLE, by_month="order_date")
    rows = stage(_sales_rows(spark, folder), "sales-rows")
    key = ["order_id", "product_id"]
    table.load(rows.where(F.col("order_date") < "1998-07-01"), key)
    dearer = (F.col("price") + F.lit(1)).cast(C.MONEY)
    table.upsert(rows.where(F.col("order_date") >= "1997-01-01").withColumn("price", dearer), key)
    return table.rows()


def compacted_loads(spark, folder):
    """The lines in five loads, by the last digit of the order, of a table that keeps two at most."""
    table = ParquetTable(spark, _new_folder(spark, "sales"), C.SALES_TABLE, by_month="order_date", most_loads=2)
    rows = stage(_sales_rows(spark, folder), "sales-rows")
    for digit in range(5):
        table.append(rows.where(F.col("order_id") % 5 == digit))
    return table.rows()


def _known_customers(spark, folder):
    """Customers with proper addresses."""
    return _customers(spark, folder).withColumn(
        "email", F.concat(F.lit("c"), "customer_id", F.lit("@example.com"))
    )


def second_batch_conflicts(spark, folder):
    """What a second batch would break beside customers that are held already.

    Customers with an even id are held. The batch has all but every seventh, every tenth
    under a new name; the sales of the missing ones have no customer.
    """
    customers = _known_customers(spark, folder)
    held = customers.where("customer_id % 2 = 0")
    name = F.when(F.col("customer_id") % 10 == 0, F.concat(F.lit("n"), "username"))
    batch = customers.where("customer_id % 7 <> 0").withColumn("username", F.coalesce(name, "username"))
    fresh = stage(rows_to_insert(held, batch, ["username"]), "customers-new")
    everyone = held.unionByName(fresh)
    return V.key_conflicts(held, fresh, C.CUSTOMERS).unionByName(
        V.reference_violations(_sales(spark, folder), "customer_id", everyone, "customer_id")
    )


def second_batch_metrics(spark, folder):
    """The rows of all metric tables after two batches, in common columns.

    The first batch ends in June 1998, the second delivers everything again, a little dearer.
    """
    where, customers, weather = _new_folder(spark, "job"), _known_customers(spark, folder), _weather(spark, folder)
    run_job(spark, _sales(spark, folder).where(F.col("order_date") < "1998-07-01"), customers, weather, where)
    tables = run_job(spark, _redelivered_sales(spark, folder), customers, weather, where)

    def rows(name, key, volume, revenue, orders):
        return tables[name].rows().select(
            F.lit(name).alias("table_name"),
            F.col(key).cast("string").alias("key"),
            F.col(volume).cast("bigint").alias("volume"),
            F.col(revenue).cast(C.TOTAL).alias("revenue"),
            (F.lit(None) if orders is None else F.col(orders)).cast("bigint").alias("orders"),
        )

    grouped = ("total_sales_volume", "total_sales_revenue", "order_count")
    return (
        rows("monthly_sales_metrics", "year_month", *grouped)
        .unionByName(rows("seasonal_sales_metrics", "weather_condition", *grouped))
        .unionByName(rows("product_metrics", "product_id", "sales_volume", "total_revenue", None))
        .unionByName(rows("customer_metrics", "customer_id", "recency", "total_revenue", "frequency"))
    )


def merge_with_null_keys(spark, folder):
    """A batch whose every fiftieth order has no product, merged twice; what was set aside."""
    key = ["order_id", "product_id"]
    product = F.when(F.col("order_id") % 50 != 0, F.col("product_id"))
    batch = _redelivered_sales(spark, folder).withColumn("product_id", product)
    once = stage(insert_if_absent(_held_sales(spark, folder), batch, key), "merged")
    merged = insert_if_absent(once, batch, key).withColumn("set_aside", F.lit(False))
    return merged.unionByName(without_key(batch, key).withColumn("set_aside", F.lit(True)))


def approximate_quartile_ranks(spark, folder):
    """Whether each approximate cut has a rank within the error, over all customers."""
    totals = stage(M.customer_totals(_sales(spark, folder)), "customer-totals")
    values = M.customer_values(totals, M.latest_order_date(totals)).where("ltv IS NOT NULL")
    cuts = M.value_cuts(values, "approx")
    count = F.count(F.lit(1))
    parts = [
        F.struct(
            F.lit(p).alias("probability"),
            (
                # the cut's rank lies between the values below it and those up to it
                (F.count_if(F.col("ltv") < cut) <= (p + M.RANK_ERROR) * count)
                & (F.count_if(F.col("ltv") <= cut) >= (p - M.RANK_ERROR) * count)
            ).alias("within_bound"),
        )
        for p, cut in zip(M.QUARTILES, cuts, strict=True)
    ]
    return values.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def sketched_price_ranks(spark, folder):
    """Per month and quartile: whether the price from merged sketches has a rank within the error.

    The lines come in two batches, orders with even and odd ids; each appends its sketches to a
    table, which then is compacted. ``counted`` is what the sketches have seen, all lines of the month.
    """
    lines = measured_lines(_enriched(spark, folder), "Unknown")
    table = ParquetTable(spark, _new_folder(spark, "spreads"), C.PRICE_SPREADS, merge=merged(C.PRICE_SPREADS))
    for rest in (0, 1):
        table.append(price_spreads(lines.where(F.col("order_id") % 2 == rest)))
    table.compact()
    # a line per month, so that no line of the sales is copied
    cuts = stage(price_quantiles(table.rows(), M.QUARTILES), "price-cuts")
    cuts = cuts.groupBy("year_month", "counted").agg(F.map_from_entries(F.collect_list(F.struct("probability", "price"))).alias("cuts"))
    count = F.count(F.lit(1))
    parts = []
    for p in M.QUARTILES:
        cut = F.col("cuts")[F.lit(p)]
        below, up_to = F.count_if(F.col("price") < cut), F.count_if(F.col("price") <= cut)
        within = (below <= (p + M.RANK_ERROR) * count) & (up_to >= (p - M.RANK_ERROR) * count)
        parts.append(F.struct(F.lit(p).alias("probability"), within.alias("within_bound")))
    joined = lines.where("price IS NOT NULL").join(F.broadcast(cuts) if fits_broadcast(cuts) else cuts, "year_month")
    found = joined.groupBy("year_month", "counted").agg(F.array(*parts).alias("parts"))
    return found.select("year_month", "counted", F.inline("parts"))


def wrong_frame_problems(spark, folder):
    """What is wrong with lines without price and with quantities as text, and for how many rows."""
    lines = _sales(spark, folder).drop("price").withColumn("quantity", F.col("quantity").cast("string"))
    problems = V.schema_problems(lines, C.SALES_TABLE)
    return lines.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.explode(F.array(*map(F.lit, problems))).alias("problem"), "n_rows"
    )


def append_twice(spark, folder):
    """The lines appended to a table two times, read back."""
    table = ParquetTable(spark, _new_folder(spark, "sales"), C.SALES_TABLE, by_month="order_date")
    rows = stage(_sales_rows(spark, folder), "sales-rows")
    table.append(rows)
    table.append(rows)
    return table.rows()


def lookup_outcomes(spark, folder):
    """Outcomes by status of a service that fails at some places and is slow to answer at others."""
    keys = lookup_keys(_sales(spark, folder), _customers(spark, folder))
    answer, tries = _fetch_rule(), {}

    def fetch(asked):
        for latitude, _, epoch in asked:
            if epoch // 86400 % 13 == 0:
                raise OSError("no answer for this day")
            tries[latitude] = tries.get(latitude, 0) + 1
            if tries[latitude] == 1:
                raise OSError("not yet")
        return [answer(*key) for key in asked]

    outcomes = fetch_documents(
        keys, fetch, partitions=32, first_wait=0.0, attempts=30, on_error="skip", batch_size=1
    )
    return outcome_counts(outcomes)


def conform_types(spark, folder):
    return conform(_sales_rows(spark, folder), C.SALES_TABLE, narrow=True)


def full_job(spark, folder):
    """The whole job into six tables; returns their row counts."""
    customers = _customers(spark, folder).withColumn(
        "email", F.concat(F.lit("c"), "customer_id", F.lit("@example.com"))
    )
    tables = run_job(
        spark, _sales(spark, folder), customers, _weather(spark, folder), _new_folder(spark, "job")
    )
    return row_counts(tables)


def total_sales_per_customer(spark, folder):
    return R.total_sales_per_customer(M.customer_totals(_sales(spark, folder)))


def avg_quantity_per_product(spark, folder):
    return R.average_quantity_per_product(M.product_metrics(_sales(spark, folder)))


def top_products(spark, folder):
    return R.top_products(M.product_metrics(_sales(spark, folder)))


def monthly_trend(spark, folder):
    return R.monthly_trend(M.monthly_sales_metrics(_sales(spark, folder)))


def weather_ranking(spark, folder):
    return R.weather_ranking(M.seasonal_sales_metrics(_enriched(spark, folder)))


def entry(spark: SparkSession) -> DataFrame:
    """Customer value, segment, recency and frequency on the smallest tables."""
    return customer_metrics(spark, SMOKE)


def _llm():
    """The queries of the optional subpackage ``tillwise.llm``; None where it is left out."""
    if importlib.util.find_spec("tillwise.llm") is None:
        return None
    from tillwise.llm import queries as module

    return module


def _corpus_pipeline():
    """The optional module ``corpus_pipeline``; None where it is left out."""
    if importlib.util.find_spec("corpus_pipeline") is None:
        return None
    import corpus_pipeline

    return corpus_pipeline


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = _own_queries()
    if (llm := _llm()) is not None:
        found |= llm.queries()
        if (pipeline := _corpus_pipeline()) is not None:
            found["pipeline"] = pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = _own_sql()
    if (llm := _llm()) is not None:
        found |= llm.oracle_sql()
        pipeline = _corpus_pipeline()
        if pipeline is not None and pipeline.ORACLE_SQL is not None:
            found["pipeline"] = pipeline.ORACLE_SQL
    return found


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "sales_fact": sales_fact,
        "customer_metrics": customer_metrics,
        "customer_metrics_approx": customer_metrics_approx,
        "ltv_quantiles": ltv_quantiles,
        "product_metrics": product_metrics,
        "monthly_sales_metrics": monthly_sales_metrics,
        "seasonal_sales_metrics": seasonal_sales_metrics,
        "enrich_customer": enrich_customer,
        "lookup_keys": lookup_keys_query,
        "enrich_weather": enrich_weather,
        "enriched_sales": enriched_sales,
        "lookup_missing": lookup_missing,
        "date_epoch": date_epoch,
        "json_flatten": json_flatten,
        "flatten_user_documents": flatten_user_documents,
        "user_file": user_file,
        "sales_csv": sales_csv,
        "unreadable_lines": unreadable_lines,
        "validation_report": validation_report,
        "constraint_report": constraint_report,
        "customer_constraint_report": customer_constraint_report,
        "invalid_lines": invalid_lines,
        "key_duplicates": key_duplicates,
        "orphans": orphan_customers,
        "merge_sales": merge_sales,
        "merge_sales_counts": merge_sales_counts,
        "upsert_sales": upsert_sales,
        "merge_customers": merge_customers,
        "staged_load": staged_load,
        "upsert_table": upsert_table,
        "compacted_loads": compacted_loads,
        "conform_types": conform_types,
        "full_job": full_job,
        "second_batch_conflicts": second_batch_conflicts,
        "second_batch_metrics": second_batch_metrics,
        "merge_with_null_keys": merge_with_null_keys,
        "approximate_quartile_ranks": approximate_quartile_ranks,
        "sketched_price_ranks": sketched_price_ranks,
        "wrong_frame_problems": wrong_frame_problems,
        "append_twice": append_twice,
        "lookup_outcomes": lookup_outcomes,
        "total_sales_per_customer": total_sales_per_customer,
        "avg_quantity_per_product": avg_quantity_per_product,
        "top_products": top_products,
        "monthly_trend": monthly_trend,
        "weather_ranking": weather_ranking,
    }


# --------------------------------------------------------------------------- SQL

_SALES_SQL = """
sales AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(o_orderdate AS DATE) AS order_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_CUSTOMERS_SQL = """
customers AS (
  SELECT c_custkey AS customer_id, c_name AS name, c_name AS username,
         CASE WHEN c_custkey % 97 = 0 THEN 'c' || c_custkey || '.example'
              ELSE 'c' || c_custkey || '@example.com' END AS email,
         CAST(c_nationkey * 7 - 85 AS FLOAT) AS latitude,
         CAST(c_nationkey * 14 - 170 AS FLOAT) AS longitude
  FROM customer
)"""

_WEATHER_SQL = """
place_days AS (
  SELECT DISTINCT latitude, longitude, order_date FROM sales JOIN customers USING (customer_id)
),
numbered AS (
  SELECT *, CAST((latitude + 85) / 7 AS INTEGER) AS nation, dayofyear(order_date) AS doy FROM place_days
),
weather AS (
  SELECT latitude, longitude, order_date,
         CAST(((nation * 13 + doy) % 500) / 10.0 - 10 AS FLOAT) AS temperature,
         CASE (nation * 7 + doy) % 4 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds'
              WHEN 2 THEN 'Rain' ELSE 'Snow' END AS weather_condition
  FROM numbered WHERE (nation + doy) % 11 <> 0
)"""

_ENRICHED_SQL = f"""{_SALES_SQL},{_CUSTOMERS_SQL},{_WEATHER_SQL},
enriched AS (
  SELECT s.*, c.name, c.username, c.email, c.latitude, c.longitude,
         w.temperature, w.weather_condition
  FROM sales s
  LEFT JOIN customers c ON s.customer_id = c.customer_id
  LEFT JOIN weather w ON c.latitude = w.latitude AND c.longitude = w.longitude
                     AND s.order_date = w.order_date
)"""

_VALUES_SQL = f"""{_SALES_SQL},
totals AS (
  SELECT customer_id, CAST(sum(price) AS DECIMAL(28,2)) AS total_revenue,
         min(order_date) AS first_day, max(order_date) AS last_day,
         count(DISTINCT order_id) AS frequency
  FROM sales GROUP BY customer_id
),
customer_values AS (
  SELECT customer_id, total_revenue, frequency,
         CAST(total_revenue AS DOUBLE)
           / nullif(CAST(datediff('day', first_day, (SELECT max(last_day) FROM totals)) AS DOUBLE), 0) AS ltv,
         CAST(datediff('day', last_day, (SELECT max(last_day) FROM totals)) AS INTEGER) AS recency
  FROM totals
),
cuts AS (
  SELECT quantile_disc(ltv, 0.25) AS q1, quantile_disc(ltv, 0.5) AS q2, quantile_disc(ltv, 0.75) AS q3
  FROM customer_values
)"""

_GROUPED = """
  CAST(sum(quantity) AS BIGINT) AS total_sales_volume,
  CAST(sum(price) AS DECIMAL(28,2)) AS total_sales_revenue,
  CAST(sum(quantity) AS DOUBLE) / CAST(count(quantity) AS DOUBLE) AS average_sales_volume"""

_PRODUCTS_SQL = f"""{_SALES_SQL},
products AS (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS sales_volume,
         CAST(sum(price) AS DECIMAL(28,2)) AS total_revenue,
         CAST(sum(quantity) AS DOUBLE) / CAST(count(quantity) AS DOUBLE) AS average_order_quantity
  FROM sales GROUP BY product_id
)"""

_HELD_SQL = """
held AS (
  SELECT order_id, customer_id, product_id, quantity, price, order_date FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, product_id
                                 ORDER BY customer_id, quantity, price, order_date) AS rn
    FROM sales WHERE order_date < DATE '1998-07-01')
  WHERE rn = 1
)"""

_BATCH_SQL = """
redelivered AS (
  SELECT order_id, customer_id, product_id, quantity,
         CAST(price + 1 AS DECIMAL(18,2)) AS price, order_date FROM sales
),
batch AS (
  SELECT order_id, customer_id, product_id, quantity, price, order_date FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, product_id
                                 ORDER BY customer_id, quantity, price, order_date) AS rn
    FROM redelivered)
  WHERE rn = 1
)"""


def _reports(parts: list[tuple[str, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, CAST({count} AS BIGINT) AS violations FROM {source}"
        for rule, count in parts
    )


def _count_where(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


_EMAIL_SQL = r"NOT regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}')"

_SALE_RULES_SQL = [
    ("email_format", _EMAIL_SQL),
    ("latitude_range", "latitude NOT BETWEEN -90 AND 90"),
    ("longitude_range", "longitude NOT BETWEEN -180 AND 180"),
    ("quantity_negative", "quantity < 0"),
]


def _too_wide(column: str, declared: str) -> str:
    return f"{column} IS NOT NULL AND TRY_CAST({column} AS {declared}) IS NULL"


_SALES_CONSTRAINTS_SQL = [
    ("total_records", "count(*)"),
    *[
        (f"{c}_not_null", _count_where(f"{c} IS NULL"))
        for c in ("order_id", "customer_id", "product_id", "quantity", "price", "order_date")
    ],
    *[
        (f"{c}_fits", _count_where(_too_wide(c, "INTEGER")))
        for c in ("order_id", "customer_id", "product_id")
    ],
    ("price_fits", _count_where(_too_wide("price", "DECIMAL(10,2)"))),
    ("temperature_fits", _count_where(_too_wide("temperature", "DECIMAL(5,2)"))),
    ("weather_condition_length", _count_where("length(weather_condition) > 255")),
    ("quantity_positive", _count_where("NOT quantity > 0")),
    ("temperature_plausible", _count_where("NOT temperature BETWEEN -100 AND 100")),
    (
        "order_id_product_id_unique",
        "(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM enriched GROUP BY order_id, product_id))",
    ),
    (
        "customer_id_reference",
        "(SELECT count(*) FROM enriched e WHERE NOT EXISTS"
        " (SELECT 1 FROM customers c WHERE c.customer_id = e.customer_id))",
    ),
]

_CUSTOMER_CONSTRAINTS_SQL = [
    ("total_records", "count(*)"),
    *[
        (f"{c}_not_null", _count_where(f"{c} IS NULL"))
        for c in ("customer_id", "name", "username", "email")
    ],
    *[(f"{c}_length", _count_where(f"length({c}) > 255")) for c in ("name", "username", "email")],
    ("customer_id_fits", _count_where(_too_wide("customer_id", "INTEGER"))),
    ("latitude_fits", _count_where(_too_wide("latitude", "DECIMAL(9,6)"))),
    ("longitude_fits", _count_where(_too_wide("longitude", "DECIMAL(9,6)"))),
    *[
        (f"{c}_unique", f"count({c}) - count(DISTINCT {c})")
        for c in ("customer_id", "username", "email")
    ],
]


def _from_scalar_counts(parts: list[tuple[str, str]], source: str) -> str:
    """Counts that are whole subqueries need no FROM."""
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, CAST({count} AS BIGINT) AS violations"
        + ("" if count.startswith("(SELECT") else f" FROM {source}")
        for rule, count in parts
    )


def _own_sql() -> dict[str, str]:
    lines = f"WITH {_SALES_SQL},{_CUSTOMERS_SQL}"
    merged = """
      SELECT * FROM held UNION ALL
      SELECT b.* FROM batch b WHERE NOT EXISTS (
        SELECT 1 FROM held h WHERE h.order_id = b.order_id AND h.product_id = b.product_id)"""
    users = f"WITH {_CUSTOMERS_SQL} SELECT * FROM customers"
    return {
        "sales_fact": f"WITH {_SALES_SQL} SELECT * FROM sales",
        "customer_metrics": f"""WITH {_VALUES_SQL}
            SELECT customer_id, ltv,
                   CASE WHEN ltv <= q1 THEN 'Low' WHEN ltv <= q2 THEN 'Medium'
                        WHEN ltv <= q3 THEN 'High' ELSE 'Very High' END AS ltv_segment,
                   recency, frequency, total_revenue
            FROM customer_values, cuts""",
        "ltv_quantiles": f"""WITH {_VALUES_SQL}
            SELECT CAST(0.25 AS DOUBLE) AS probability, q1 AS value FROM cuts UNION ALL
            SELECT CAST(0.5 AS DOUBLE), q2 FROM cuts UNION ALL
            SELECT CAST(0.75 AS DOUBLE), q3 FROM cuts""",
        "product_metrics": f"WITH {_PRODUCTS_SQL} SELECT * FROM products",
        "monthly_sales_metrics": f"""WITH {_SALES_SQL}
            SELECT strftime(order_date, '%Y-%m') AS year_month, {_GROUPED},
                   count(DISTINCT order_id) AS order_count
            FROM sales GROUP BY 1""",
        "seasonal_sales_metrics": f"""WITH {_ENRICHED_SQL}
            SELECT weather_condition, {_GROUPED}, count(DISTINCT order_id) AS order_count
            FROM enriched GROUP BY weather_condition""",
        "enrich_customer": f"""{lines}
            SELECT s.*, c.name, c.username, c.email, c.latitude, c.longitude
            FROM sales s LEFT JOIN customers c ON s.customer_id = c.customer_id""",
        "lookup_keys": f"{lines},{_WEATHER_SQL} SELECT * FROM place_days",
        "enrich_weather": f"""WITH {_ENRICHED_SQL}
            SELECT order_id, product_id, quantity, price, latitude, longitude, order_date,
                   temperature, weather_condition FROM enriched""",
        "enriched_sales": f"WITH {_ENRICHED_SQL} SELECT * FROM enriched",
        "lookup_missing": f"{lines},{_WEATHER_SQL} SELECT * FROM weather",
        "date_epoch": """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
            CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT) AS epoch FROM orders""",
        "json_flatten": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
            FROM events""",
        "flatten_user_documents": users,
        "user_file": users,
        "sales_csv": f"WITH {_SALES_SQL} SELECT * FROM sales",
        "unreadable_lines": f"""WITH {_SALES_SQL},
            texts AS (
              SELECT concat_ws(',', order_id, customer_id, product_id,
                       CASE WHEN order_id % 50 = 0 THEN 'many' ELSE CAST(quantity AS VARCHAR) END, price,
                       CASE WHEN order_id % 70 = 0 THEN '1997-13-45' ELSE CAST(order_date AS VARCHAR) END) AS line,
                     concat_ws(',', CASE WHEN order_id % 50 = 0 THEN 'quantity' END,
                               CASE WHEN order_id % 70 = 0 THEN 'order_date' END) AS reasons
              FROM sales)
            SELECT line, reasons, count(*) AS lines FROM texts WHERE reasons <> '' GROUP BY ALL UNION ALL
            SELECT '', 'read', count(*) FROM texts WHERE reasons = ''""",
        "validation_report": f"""{lines},
            lines AS (SELECT * FROM sales LEFT JOIN customers USING (customer_id))
            {_reports([("total_records", "count(*)")] + [(r, _count_where(c)) for r, c in _SALE_RULES_SQL], "lines")}""",
        "constraint_report": f"WITH {_ENRICHED_SQL} {_from_scalar_counts(_SALES_CONSTRAINTS_SQL, 'enriched')}",
        "customer_constraint_report": f"WITH {_CUSTOMERS_SQL} {_reports(_CUSTOMER_CONSTRAINTS_SQL, 'customers')}",
        "invalid_lines": f"""{lines},
            marked AS (
              SELECT order_id, product_id, customer_id, quantity, price, email,
                     concat_ws(',', {", ".join(f"CASE WHEN {c} THEN '{r}' END" for r, c in _SALE_RULES_SQL)}) AS broken_rules
              FROM sales LEFT JOIN customers USING (customer_id))
            SELECT * FROM marked WHERE broken_rules <> ''""",
        "key_duplicates": f"""WITH {_SALES_SQL}
            SELECT order_id, product_id, count(*) AS copies FROM sales
            GROUP BY order_id, product_id HAVING count(*) > 1""",
        "orphans": f"""WITH {_SALES_SQL}
            SELECT customer_id, count(*) AS lines FROM sales
            WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = customer_id AND c_acctbal > 0)
            GROUP BY customer_id""",
        "merge_sales": f"WITH {_SALES_SQL},{_HELD_SQL},{_BATCH_SQL} {merged}",
        "merge_sales_counts": f"""WITH {_SALES_SQL},{_HELD_SQL},{_BATCH_SQL},
            present AS (
              SELECT count(*) AS n FROM batch b WHERE EXISTS (
                SELECT 1 FROM held h WHERE h.order_id = b.order_id AND h.product_id = b.product_id))
            SELECT (SELECT count(*) FROM redelivered) AS batch_rows,
                   (SELECT count(*) FROM redelivered) - (SELECT count(*) FROM batch) AS copies_in_batch,
                   (SELECT n FROM present) AS already_present,
                   (SELECT count(*) FROM batch) - (SELECT n FROM present) AS inserted,
                   CAST(0 AS BIGINT) AS without_key""",
        "upsert_sales": f"""WITH {_SALES_SQL},{_HELD_SQL},{_BATCH_SQL},
            late AS (SELECT * FROM batch WHERE order_date >= DATE '1997-01-01')
            SELECT * FROM late UNION ALL
            SELECT h.* FROM held h WHERE NOT EXISTS (
              SELECT 1 FROM late b WHERE h.order_id = b.order_id AND h.product_id = b.product_id)""",
        "merge_customers": f"""{lines},
            held AS (
              SELECT customer_id, name, username, 'old.' || email AS email, latitude, longitude
              FROM customers WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')),
            seen AS (
              SELECT DISTINCT customer_id, name, username, email, latitude, longitude
              FROM sales JOIN customers USING (customer_id))
            SELECT * FROM held UNION ALL
            SELECT * FROM seen WHERE username NOT IN (SELECT username FROM held)""",
        "staged_load": f"""WITH {_ENRICHED_SQL},{_HELD_SQL},{_BATCH_SQL},
            merged AS ({merged})
            SELECT m.*, w.temperature, w.weather_condition
            FROM merged m
            LEFT JOIN customers c ON m.customer_id = c.customer_id
            LEFT JOIN weather w ON c.latitude = w.latitude AND c.longitude = w.longitude
                               AND m.order_date = w.order_date""",
        "upsert_table": f"""WITH {_ENRICHED_SQL},{_HELD_SQL},{_BATCH_SQL},
            late AS (SELECT * FROM batch WHERE order_date >= DATE '1997-01-01'),
            merged AS (
              SELECT * FROM late UNION ALL
              SELECT h.* FROM held h WHERE NOT EXISTS (
                SELECT 1 FROM late b WHERE h.order_id = b.order_id AND h.product_id = b.product_id))
            SELECT m.*, w.temperature, w.weather_condition
            FROM merged m
            LEFT JOIN customers c ON m.customer_id = c.customer_id
            LEFT JOIN weather w ON c.latitude = w.latitude AND c.longitude = w.longitude
                               AND m.order_date = w.order_date""",
        "compacted_loads": f"""WITH {_ENRICHED_SQL}
            SELECT order_id, customer_id, product_id, quantity, price, order_date, temperature, weather_condition
            FROM enriched""",
        "conform_types": f"""WITH {_ENRICHED_SQL}
            SELECT CAST(order_id AS INTEGER) AS order_id, CAST(customer_id AS INTEGER) AS customer_id,
                   CAST(product_id AS INTEGER) AS product_id, quantity,
                   CAST(price AS DECIMAL(10,2)) AS price, order_date,
                   CAST(temperature AS DECIMAL(5,2)) AS temperature, weather_condition
            FROM enriched""",
        "full_job": f"""WITH {_ENRICHED_SQL}
            SELECT 'customers' AS table_name, count(DISTINCT username) AS row_count FROM enriched UNION ALL
            SELECT 'sales', count(DISTINCT (order_id, product_id)) FROM enriched UNION ALL
            SELECT 'customer_metrics', count(DISTINCT customer_id) FROM enriched UNION ALL
            SELECT 'product_metrics', count(DISTINCT product_id) FROM enriched UNION ALL
            SELECT 'seasonal_sales_metrics', count(DISTINCT coalesce(weather_condition, 'Unknown')) FROM enriched UNION ALL
            SELECT 'monthly_sales_metrics', count(DISTINCT strftime(order_date, '%Y-%m')) FROM enriched""",
        "second_batch_conflicts": f"""{lines},
            held AS (SELECT * FROM customers WHERE customer_id % 2 = 0),
            batch AS (
              SELECT customer_id, CASE WHEN customer_id % 10 = 0 THEN 'n' || username ELSE username END AS username
              FROM customers WHERE customer_id % 7 <> 0),
            fresh AS (SELECT * FROM batch WHERE username NOT IN (SELECT username FROM held)),
            clash AS (SELECT count(*) AS n FROM fresh WHERE customer_id IN (SELECT customer_id FROM held))
            SELECT 'customer_id_unique' AS rule, n AS violations FROM clash UNION ALL
            SELECT 'username_unique', CAST(0 AS BIGINT) UNION ALL
            SELECT 'email_unique', n FROM clash UNION ALL
            SELECT 'customer_id_reference', count(*) FROM sales
            WHERE customer_id NOT IN (SELECT customer_id FROM held UNION SELECT customer_id FROM fresh)""",
        "second_batch_metrics": f"""WITH {_SALES_SQL},{_CUSTOMERS_SQL},{_WEATHER_SQL},{_HELD_SQL},{_BATCH_SQL},
            merged AS ({merged}),
            full_lines AS (
              SELECT m.*, coalesce(w.weather_condition, 'Unknown') AS condition FROM merged m
              LEFT JOIN customers c ON m.customer_id = c.customer_id
              LEFT JOIN weather w ON c.latitude = w.latitude AND c.longitude = w.longitude
                                 AND m.order_date = w.order_date)
            SELECT 'monthly_sales_metrics' AS table_name, strftime(order_date, '%Y-%m') AS key,
                   CAST(sum(quantity) AS BIGINT) AS volume, CAST(sum(price) AS DECIMAL(28,2)) AS revenue,
                   count(DISTINCT order_id) AS orders FROM merged GROUP BY 2 UNION ALL
            SELECT 'seasonal_sales_metrics', condition, CAST(sum(quantity) AS BIGINT),
                   CAST(sum(price) AS DECIMAL(28,2)), count(DISTINCT order_id) FROM full_lines GROUP BY 2 UNION ALL
            SELECT 'product_metrics', CAST(product_id AS VARCHAR), CAST(sum(quantity) AS BIGINT),
                   CAST(sum(price) AS DECIMAL(28,2)), CAST(NULL AS BIGINT) FROM merged GROUP BY 2 UNION ALL
            SELECT 'customer_metrics', CAST(customer_id AS VARCHAR),
                   datediff('day', max(order_date), (SELECT max(order_date) FROM merged)),
                   CAST(sum(price) AS DECIMAL(28,2)), count(DISTINCT order_id)
            FROM merged GROUP BY customer_id""",
        "merge_with_null_keys": f"""WITH {_SALES_SQL},{_HELD_SQL},{_BATCH_SQL}
            SELECT *, false AS set_aside FROM held UNION ALL
            SELECT b.*, false FROM batch b WHERE order_id % 50 <> 0 AND NOT EXISTS (
              SELECT 1 FROM held h WHERE h.order_id = b.order_id AND h.product_id = b.product_id) UNION ALL
            SELECT order_id, customer_id, NULL, quantity, price, order_date, true
            FROM redelivered WHERE order_id % 50 = 0""",
        "approximate_quartile_ranks": """SELECT CAST(p AS DOUBLE) AS probability, true AS within_bound
            FROM (VALUES (0.25), (0.5), (0.75)) t(p)""",
        "sketched_price_ranks": f"""WITH {_SALES_SQL}
            SELECT strftime(order_date, '%Y-%m') AS year_month, count(price) AS counted,
                   CAST(p AS DOUBLE) AS probability, true AS within_bound
            FROM sales, (VALUES (0.25), (0.5), (0.75)) t(p) GROUP BY 1, p""",
        "wrong_frame_problems": f"""WITH {_SALES_SQL}
            SELECT problem, (SELECT count(*) FROM sales) AS n_rows FROM (VALUES
              ('missing column price'), ('column quantity is string, expected int'),
              ('missing column temperature'), ('missing column weather_condition')) t(problem)""",
        "append_twice": f"""WITH {_ENRICHED_SQL}, lines AS (
              SELECT order_id, customer_id, product_id, quantity, price, order_date, temperature, weather_condition
              FROM enriched)
            SELECT * FROM lines UNION ALL SELECT * FROM lines""",
        "lookup_outcomes": f"""{lines},{_WEATHER_SQL}
            SELECT CASE WHEN CAST(epoch(order_date) AS BIGINT) // 86400 % 13 = 0 THEN 'failed'
                        WHEN (nation + doy) % 11 = 0 THEN 'empty' ELSE 'ok' END AS status,
                   count(*) AS keys
            FROM numbered GROUP BY 1""",
        "total_sales_per_customer": f"""WITH {_SALES_SQL}
            SELECT customer_id, CAST(sum(price) AS DECIMAL(28,2)) AS total_sales_amount
            FROM sales GROUP BY customer_id""",
        "avg_quantity_per_product": f"WITH {_PRODUCTS_SQL} SELECT product_id, average_order_quantity FROM products",
        "top_products": f"""WITH {_PRODUCTS_SQL}
            SELECT product_id, sales_volume FROM products ORDER BY sales_volume DESC, product_id LIMIT 5""",
        "monthly_trend": f"""WITH {_SALES_SQL}
            SELECT strftime(order_date, '%Y-%m') AS year_month, {_GROUPED}
            FROM sales GROUP BY 1 ORDER BY 1""",
        "weather_ranking": f"""WITH {_ENRICHED_SQL}
            SELECT weather_condition, {_GROUPED}
            FROM enriched GROUP BY weather_condition ORDER BY total_sales_volume DESC""",
    }
