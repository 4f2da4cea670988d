"""Readers, writers, upserts and ad-hoc SQL."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from martlet.operators import panels
from martlet.operators.intermediate import int_customer_ltv
from martlet.operators.marts import MARTS, build_marts, fct_daily_revenue, fct_orders, order_revenue
from martlet.operators.staging import stg_orders
from martlet.sources import io
from martlet.sources.adapters import ADAPTERS
from martlet.sources.registry import file_sources, logical_name, source_names
from martlet.sources.schemas import SCHEMAS, schema_of
from tests.conftest import rows


def test_logical_names():
    assert logical_name("shop_orders_dataset.csv", prefix="shop_") == "orders"
    assert logical_name("/data/product_category_name_translation.csv") == "category_translation"
    assert logical_name("hubspot_deals.csv") == "hubspot_deals"


def test_every_source_has_a_schema():
    assert set(ADAPTERS) <= set(SCHEMAS) and source_names() == sorted(SCHEMAS)
    assert all(schema_of(n).fields for n in SCHEMAS)


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,n\na,1\nb,x\n")
    with pytest.raises(Exception, match="MALFORMED|CAST|FAILFAST|Malformed"):
        io.read_csv_table(spark, str(tmp_path / "t.csv"), "id string, n int").collect()


def test_upsert_last_row_wins(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    batch = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, None, 1)], "id int, v string, seq int")
    assert rows(io.upsert(target, batch, ["id"], ["seq"])) == {(1, "a"), (2, "y"), (3, None)}


def test_null_clean(spark):
    df = spark.createDataFrame([(1, math.nan), (2, 1.5), (3, None)], "id int, v double")
    assert rows(io.null_clean(df)) == {(1, None), (2, 1.5), (3, None)}


def test_write_append_report(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    path = str(tmp_path / "t")
    io.write_table(df, path)
    assert io.append(df, path).count() == 4
    assert io.write_table(df, path).count() == 2
    assert rows(io.load_report({"t": df, "u": df.limit(0)})) == {("t", 2), ("u", 0)}
    assert rows(io.describe_tables({"t": df})) == {("t", 2, 1, 1, "id", "int")}
    assert io.limit_rows(df, 1, [F.col("id").desc()]).first().id == 2


def test_run_sql_reads_only(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    got, error = io.run_sql(spark, "SELECT COUNT(*) AS n FROM numbers", {"numbers": df})
    assert error is None and got.first().n == 2
    for bad in ("DROP TABLE numbers", "INSERT INTO numbers VALUES (1)", "WITH a AS (SELECT 1) INSERT INTO numbers SELECT * FROM a"):
        got, error = io.run_sql(spark, bad, {"numbers": df})
        assert got is None and "SELECT" in error
    for escape in ("SELECT TRANSFORM(id) USING 'cat' AS x FROM numbers", "SELECT java_method('java.lang.Math', 'abs', 1)",
                   "SELECT try_reflect('java.lang.Math', 'abs', 1)"):
        got, error = io.run_sql(spark, escape, {"numbers": df})
        assert got is None and "not allowed" in error
    got, error = io.run_sql(spark, "SELECT 1 / 0 AS x", {}, check=True)
    assert got is None and "DIVIDE_BY_ZERO" in error
    got, error = io.run_sql(spark, "SELECT nothing FROM numbers", {"numbers": df})
    assert got is None and "nothing" in error


@pytest.fixture(scope="module")
def files(spark, src, tmp_path_factory):
    base = tmp_path_factory.mktemp("files")
    names = ["orders", "order_payments", "customers", "order_items", "order_reviews", "marketing_attribution"]
    for name in names:
        typed = src.table(name).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema_of(name).fields]
        )
        typed.write.parquet(str(base / "parquet" / name))
        if name != "order_reviews":
            typed.write.option("header", True).csv(str(base / "csv" / name))
    return base, names


def test_csv_and_parquet_files_give_the_same_models(spark, src, files):
    base, names = files
    by_format = [
        file_sources(spark, {n: str(base / fmt / n) for n in names}, fmt) for fmt in ("csv", "parquet")
    ]
    csv, parquet = (rows(int_customer_ltv(s)) for s in by_format)
    assert csv == parquet and len(csv) == int_customer_ltv(src).count()


def test_filters_and_columns_reach_the_scan(spark, files):
    base, names = files
    stored = file_sources(spark, {n: str(base / "parquet" / n) for n in names}, "parquet")
    plan = panels.delivery_stats(stored, "1996-01-01", "1996-12-31")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,delivered)" in plan
    assert "GreaterThanOrEqual(order_purchase_timestamp" in plan and "LessThan(order_purchase_timestamp" in plan
    assert "customer_id" not in plan.split("ReadSchema")[1]


def test_marts_are_stored_and_then_read(spark, src, tmp_path):
    from tests.conftest import SF_DIR
    from martlet.sources.registry import derived_sources

    fresh = derived_sources(spark, SF_DIR)
    before = rows(fct_daily_revenue(src))
    build_marts(fresh, str(tmp_path), ["fct_orders", "fct_daily_revenue"])
    assert set(fresh.stored) == {"fct_orders", "fct_daily_revenue"} and set(MARTS) > set(fresh.stored)
    assert "fct_orders" in fresh.model(order_revenue)._jdf.queryExecution().toString()
    assert rows(fresh.model(fct_daily_revenue)) == before
    assert fresh.model(fct_orders).count() == src.model(stg_orders).filter("order_status = 'delivered'").count()
