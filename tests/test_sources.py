"""Registry, catalog access, shared folder, and derived inputs."""

import json

import pytest

from plumbline import session, validate, validate_all
from plumbline.plans.queries.tables import two_states
from plumbline.plans.suites import consolidated
from plumbline.sources import events
from plumbline.sources.registry import Warehouse, from_catalog, from_parquet, save_bucketed, schema_drift
from plumbline.sources.schemas import TABLES, columns, schema
from plumbline.sources.star import sales, stored_sales
from plumbline.sources.suite_store import load_project, load_suites, save_suites


def test_drift_of_stored_files(spark, small_star, tmp_path):
    from pyspark.sql import functions as F

    root = str(tmp_path / "w")
    small_star.snapshot(spark, root)
    store = small_star["dim_store"]
    moved = ["store_id", "store_key", "store_name", "city", "region", "store_type", "opening_date"]  # state is gone
    (store.select(*moved).withColumn("store_key", F.col("store_key").cast("int")).withColumnRenamed("city", "town")
     .withColumn("extra", F.lit(1)).write.mode("overwrite").parquet(f"{root}/dim_store"))
    warehouse = from_parquet(spark, root)
    found = {(r.table_name, r.column_name): r.status for r in schema_drift(spark, warehouse).collect()}
    assert {k: v for k, v in found.items() if v != "OK"} == {
        ("dim_store", "state"): "MISSING", ("dim_store", "city"): "MISSING", ("dim_store", "town"): "EXTRA",
        ("dim_store", "extra"): "EXTRA", ("dim_store", "store_key"): "RETYPED", ("dim_store", "store_id"): "MOVED"}
    results = validate_all(warehouse, {t: s.subset(kinds=["column_order"]) for t, s in consolidated().items()
                                       if s.subset(kinds=["column_order"]).checks})
    assert {r.table_name for r in results.where("status = 'FAIL'").collect()} == {"dim_store"}
    from plumbline.operators.contracts import type_report
    from plumbline.plans.contracts import TABLES

    contract = next(c for c in TABLES if c.table == "dim_store")
    report = type_report(warehouse["dim_store"], contract, warehouse.stored["dim_store"])
    assert {r.column_name for r in report.where("not conforms").collect()} >= {"store_key", "state", "city"}


def test_tables_are_built_when_asked_for(spark):
    built = []

    def table():
        built.append(1)
        return spark.range(3)

    w = Warehouse({"t": table})
    assert not built and list(w) == ["t"]
    assert w["t"].count() == w["t"].count() == 3
    assert built == [1]
    assert w.replaced(t=spark.range(5))["t"].count() == 5 and w["t"].count() == 3


def test_catalog_tables(spark, small_star):
    small_star["dim_store"].createOrReplaceGlobalTempView("dim_store")
    w = from_catalog(spark, "global_temp", ["dim_store"])
    assert w.head("dim_store", 2, "store_key").count() == 2


def test_bucketed_table_needs_no_shuffle_for_its_key(spark, small_star, tmp_path):
    sales = save_bucketed(small_star["fact_sales"], "bucketed_sales", ["order_id", "order_line_num"], 4,
                          str(tmp_path / "sales"))
    try:
        suite = consolidated()["fact_sales"].subset(kinds=["duplicate_key"])
        assert validate(sales, suite).first().unexpected_count == 0
        text = validate(sales, suite)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in text
    finally:
        spark.sql("DROP TABLE bucketed_sales")


def test_views(spark, small_star):
    small_star.register_views()
    assert spark.sql("select count(*) from fact_sales join dim_store using (store_key)").first()[0] == 5_000


def test_declared_schemas(spark):
    for table in TABLES:
        assert schema(table).fieldNames() == columns(table)


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_dir(spark)
    assert folder == (named or spark.sparkContext.getCheckpointDir())
    first, second = (session.new_table_path(spark, "x") for _ in range(2))
    assert first != second and first.startswith(folder)


def test_suites_on_disk(tmp_path):
    save_suites(tmp_path, consolidated())
    save_suites(tmp_path, consolidated())
    assert load_suites(tmp_path) == consolidated()


def test_stored_project_runs_as_it_is(spark, small_star, tmp_path):
    """Checks written for PostgreSQL by another tool, with the pairing of suite and table in a file of its own."""
    sql = lambda text, **meta: {"type": "unexpected_rows_expectation", "kwargs": {"unexpected_rows_query": text},
                                "meta": meta}
    suites = {
        "calendar": [sql("SELECT date_key FROM {batch} WHERE EXTRACT(YEAR FROM full_date)::INT <> year_number + 1"),
                     sql("SELECT 1 AS x FROM (SELECT CAST(COUNT(*) FILTER (WHERE is_weekend = TRUE) AS FLOAT) "
                         "/ NULLIF(COUNT(*), 0) AS w FROM {batch}) r WHERE r.w NOT BETWEEN 0.25 AND 0.32"),
                     sql("SELECT date_key FROM {batch} WHERE full_date > CURRENT_DATE")],
        "stores": [sql("SELECT store_key FROM {batch} WHERE store_id !~ '^STR[0-9]+$'"),
                   sql("SELECT region FROM (SELECT region, CAST(COUNT(*) AS FLOAT) / NULLIF(SUM(COUNT(*)) OVER (), 0) "
                       "AS share FROM {batch} GROUP BY region) t WHERE share > 0.2", dimension="Validity"),
                   {"type": "expect_column_values_to_be_between", "kwargs": {
                       "column": "opening_date", "min_value": "1990-01-01", "max_value": "2030-12-31"}}],
        "sales": [sql("SELECT f.sales_key FROM {batch} f LEFT JOIN warehouse.dim_store s ON f.store_key = s.store_key "
                      "WHERE s.store_key IS NULL", dimension="Consistency", issue_id="X-1", predicted="FAIL"),
                  sql("SELECT sales_key FROM {batch} WHERE ABS(net_revenue - (quantity * unit_price)) > 0.01")],
    }
    for folder in ("expectations", "validation_definitions"):
        (tmp_path / folder).mkdir()
    for (name, checks), table in zip(suites.items(), ("dim_date", "dim_store", "fact_sales")):
        (tmp_path / "expectations" / f"{name}.json").write_text(json.dumps({"name": name, "expectations": checks}))
        (tmp_path / "validation_definitions" / f"v_{name}.json").write_text(json.dumps(
            {"suite": {"name": name}, "data": {"asset": {"name": table}, "batch_definition": {"name": "whole"}}}))
    w = small_star.replaced(dim_store=small_star["dim_store"].where("store_key > 2"))
    got = {(r.table_name, r.check_no): r.unexpected_count
           for r in validate_all(w, load_project(tmp_path), as_of="2024-06-30").collect()}
    assert got == {("dim_date", 1): 366, ("dim_date", 2): 0, ("dim_date", 3): 184, ("dim_store", 1): 0,
                   ("dim_store", 2): 4, ("dim_store", 3): 0, ("fact_sales", 1): 50, ("fact_sales", 2): 5000}


def test_a_cluster_must_name_its_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_bad_days_of_the_daily_load(spark, tmp_path):
    rows = ", ".join(f"({i}, timestamp_ntz '2024-01-{d} 10:00:00', {i}, '{kind}', 1.0D, '')" for i, (d, kind) in enumerate(
        [("02", "click"), ("15", "click"), ("15", "view"), ("24", "error"), ("25", "view")]))
    spark.sql(f"select * from values {rows} as t(event_id, ts, user_id, event_type, value, props)").selectExpr(
        "cast(event_id as bigint) event_id", "ts", "cast(user_id as bigint) user_id", "event_type", "value",
        "props").write.parquet(str(tmp_path / "events.parquet"))
    counts = {str(r.load_date): r["count"] for r in
              events.daily_load(spark, str(tmp_path)).groupBy("load_date").count().collect()}
    assert counts == {"2024-01-02": 2, "2024-01-15": 1, "2024-01-24": 3, "2024-01-25": 1}
    assert events.load_log(spark, str(tmp_path)).where("table_name = 'fact_sales'").count() == 2


def test_footers_are_read_when_asked_for(spark, tmp_path):
    spark.range(3).withColumnRenamed("id", "store_key").write.parquet(str(tmp_path / "dim_store"))
    w = from_parquet(spark, str(tmp_path), ["dim_store"])
    later = w.replaced(dim_date=spark.range(1))
    assert all(not hasattr(s, "fields") for s in [*w.stored.parts().values(), *later.stored.parts().values()])
    assert later.stored["dim_store"].names == ["store_key"] and list(later.stored) == ["dim_store"]
    assert w.replaced(dim_store=spark.range(1)).stored.get("dim_store") is None


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def odd_orders(spark, tmp_path_factory):
    """Orders and lines with nulls, lines without an order, and copies."""
    root = tmp_path_factory.mktemp("orders")
    lines = spark.range(400).selectExpr(
        "if(id % 50 = 9, null, id div 4) as l_orderkey", "id % 7 as l_partkey", "if(id % 31 = 3, null, id % 5) as l_suppkey",
        "cast(id % 4 + 1 as int) as l_linenumber", "if(id % 41 = 5, null, double(id % 9 + 1)) as l_quantity",
        "if(id % 37 = 6, null, double(id) * 10.01) as l_extendedprice", "double(id % 11) / 100 as l_discount",
        "if(id % 43 = 7, null, double(id % 9) / 100) as l_tax", "'N' as l_returnflag", "'O' as l_linestatus",
        "timestamp_ntz '1997-01-01 00:00:00' as l_shipdate")
    orders = spark.range(90).selectExpr(
        "id as o_orderkey", "if(id % 13 = 4, null, id % 20) as o_custkey", "'O' as o_orderstatus", "1.0D as o_totalprice",
        "cast(date_add(date '1995-01-01', cast(id * 29 as int)) as timestamp_ntz) as o_orderdate", "'1' as o_orderpriority")
    lines.unionAll(lines.limit(9)).write.parquet(str(root / "lineitem.parquet"))
    orders.unionAll(orders.limit(2)).write.parquet(str(root / "orders.parquet"))
    return str(root)


def test_a_stored_fact_is_the_joined_one(spark, odd_orders):
    built, kept = sales(spark, odd_orders), stored_sales(spark, odd_orders)
    assert kept.schema == built.schema and kept.count() > 300
    assert kept.exceptAll(built).count() == 0 and built.exceptAll(kept).count() == 0


def test_queries_of_two_states_join_the_lines_once(spark, odd_orders):
    before, after = two_states(spark, odd_orders)
    assert "Join" not in plan_of(before) and "Join" not in plan_of(after)


def test_lines_are_joined_as_they_are_stored(spark, odd_orders):
    """What is joined are the columns of the file; amounts are made of them afterwards."""
    plan = plan_of(sales(spark, odd_orders))
    joined = plan[plan.index("Join"):]
    assert "floor" in plan.lower() and "floor" not in joined.lower()
