"""Repairs keep rows whole and make the failed checks pass."""

import datetime as dt
import random

from pyspark.sql import functions as F

from plumbline.operators import checks as C
from plumbline.operators import defects, repair
from plumbline.operators.checks import Suite
from plumbline.operators.integrity import RELATIONSHIPS
from plumbline.operators.validate import validate, validate_all
from plumbline.plans.suites import consolidated

AS_OF = dt.date(2026, 4, 29)
CUSTOMER = next(k for k in RELATIONSHIPS if k.table == "dim_customer")


def test_repaired_warehouse_passes(spark, star):
    mirror = defects.inject(star, AS_OF)
    prices = star["dim_product"].select("product_id", F.col("list_price").alias("standard_price"))
    clean, orphans = repair.split_orphans(mirror["fact_sales"], CUSTOMER, mirror)
    kept, returned = repair.split_returns(clean)
    assert (orphans.count(), returned.count(), kept.count()) == (50, 100, 499_900)
    fixed = mirror.replaced(dim_customer=repair.repair_customers(mirror["dim_customer"], AS_OF),
                            dim_product=repair.backfill_price(mirror["dim_product"], prices), fact_sales=kept)
    left = validate_all(fixed, consolidated(), as_of=AS_OF).where("status = 'FAIL'")
    # cost above price needs a person; the duplicates are closed but stay as history rows
    assert {(r.check_type, r.unexpected_count) for r in left.collect()} == {("margin", 10), ("distinct_ratio", 1)}


def test_latest_current_row_survives(spark):
    rows = [(1, "a", "2020-01-01", "9999-12-31", True), (2, "a", "2021-01-01", "9999-12-31", True),
            (3, "a", "2021-01-01", "9999-12-31", True), (4, "a", "2019-01-01", "2019-12-31", False),
            (5, "b", "2020-01-01", "9999-12-31", True), (6, "c", "2026-04-29", "9999-12-31", True),
            (7, "c", "2026-04-29", "9999-12-31", True)]
    df = spark.createDataFrame(rows, "customer_key bigint, customer_id string, e string, x string, is_current boolean"
                               ).selectExpr("customer_key", "customer_id", "cast(e as date) as effective_date",
                                            "cast(x as date) as expiry_date", "is_current")
    got = {r.customer_key: r for r in repair.expire_duplicates(df, AS_OF).collect()}
    assert [k for k, r in sorted(got.items()) if r.is_current] == [3, 5, 7]
    assert got[1].expiry_date == dt.date(2026, 4, 28)
    assert got[4].expiry_date == dt.date(2019, 12, 31)
    assert got[6].expiry_date == dt.date(2026, 4, 29)  # never before its own start


def test_hot_business_key(spark):
    """A third of all rows under one key: still one survivor."""
    df = spark.range(3000).selectExpr("id as customer_key", "if(id < 1000, 'hot', concat('c', id)) as customer_id",
                                      "date_add(date '2020-01-01', cast(id as int)) as effective_date",
                                      "date '9999-12-31' as expiry_date", "true as is_current")
    out = repair.expire_duplicates(df, AS_OF)
    assert out.count() == 3000
    assert [r.customer_key for r in out.where("customer_id = 'hot' and is_current").collect()] == [999]


def test_one_current_row_per_key_whatever_the_rows(spark):
    """Random versions, with rows equal in everything, NULL keys and keys without a current row."""
    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.choice(["a", "b", "c", "d", None]), rng.choice(["2020-01-01", "2021-06-01"]),
             rng.choice(["x", "y", None]), rng.random() < 0.6) for _ in range(120)]
    rows += [(9, "copy", "2020-01-01", "x", True)] * 4 + [(9, "old", "2020-01-01", "x", False)] * 2
    df = spark.createDataFrame(rows, "customer_key bigint, customer_id string, e string, latest string, is_current boolean"
                               ).selectExpr("customer_key", "customer_id", "cast(e as date) as effective_date", "latest",
                                            "date '9999-12-31' as expiry_date", "is_current")
    before, after = df.collect(), repair.expire_duplicates(df, AS_OF).collect()
    ids = {r.customer_id for r in before if r.is_current and r.customer_id is not None}
    current = [r for r in after if r.is_current]
    assert sorted(r.customer_id for r in current if r.customer_id is not None) == sorted(ids)
    for i in ids:
        best = max((r.effective_date, r.customer_key) for r in before if r.customer_id == i and r.is_current)
        assert [(r.effective_date, r.customer_key) for r in current if r.customer_id == i] == [best]
    key = lambda r: (r.customer_key, r.customer_id or "", str(r.effective_date), r.latest or "")
    assert sorted(map(key, before)) == sorted(map(key, after))
    unkeyed = lambda rows: sorted((*key(r), r.is_current, str(r.expiry_date)) for r in rows if r.customer_id is None)
    assert unkeyed(before) == unkeyed(after)
    closed = [r for r in after if not r.is_current and r.expiry_date != dt.date(9999, 12, 31)]
    assert len(closed) == sum(r.is_current for r in before) - len(current)
    assert {r.expiry_date for r in closed} == {dt.date(2026, 4, 28)}


def test_duplicate_reference_rows_do_not_multiply_products(spark):
    products = spark.sql("select 'a' as product_id, cast(0 as decimal(12,2)) as list_price "
                         "union all select 'b', 5 union all select 'c', 0 union all select 'd', null")
    reference = spark.sql("select 'a' as product_id, cast(7 as decimal(12,2)) as standard_price "
                          "union all select 'a', 9 union all select 'b', 1")
    got = {r.product_id: r.list_price for r in repair.backfill_price(products, reference).collect()}
    assert got == {"a": 9, "b": 5, "c": 0, "d": None}


def test_unknown_quantity_stays_in_the_fact(spark):
    df = spark.createDataFrame([(1,), (0,), (-1,), (None,)], "quantity int")
    kept, moved = repair.split_returns(df)
    assert (kept.count(), moved.count()) == (2, 2)
    types = {r.quantity: r.transaction_type for r in repair.transaction_type(df).collect()}
    assert types == {1: "SALE", 0: "EXCHANGE", -1: "RETURN", None: "SALE"}


def test_one_pass_split_equals_two_filters(spark, star, tmp_path):
    mirror = defects.inject(star, AS_OF)
    clean, orphans = repair.route_orphans(mirror["fact_sales"], CUSTOMER, mirror, str(tmp_path / "split"))
    assert (clean.count(), orphans.count()) == (500_000, 50)
    assert clean.columns == mirror["fact_sales"].columns


def test_sentinels_and_status(spark):
    df = spark.createDataFrame([("n/a",), ("NA",), ("",), ("a@b.co",), (None,), ("bad",)], "email string")
    cleared = repair.clear_values(df, "email")
    assert cleared.where("email is null").count() == 4
    filled = repair.email_status(repair.fill_null(cleared, "email", repair.OPT_OUT_EMAIL))
    assert {r.email_status: r.n for r in filled.groupBy("email_status").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        "optout": 4, "active": 1, "unknown": 1}


def test_gate(mirror_results):
    got = {r.table_name: r.decision for r in repair.gate(mirror_results).collect()}
    assert got == {"dim_customer": "block", "dim_product": "block", "dim_store": "promote", "dim_date": "promote",
                   "fact_sales": "quarantine"}
    assert repair.load_decision(repair.gate(mirror_results)).first().decision == "block"


def test_quarantine_keeps_every_row_with_its_reasons(star):
    mirror = defects.inject(star, AS_OF)
    good, bad = repair.quarantine_critical(mirror["fact_sales"], consolidated()["fact_sales"], mirror)
    assert good.count() + bad.count() == mirror["fact_sales"].count()
    reasons = {tuple(r.violations): r["count"] for r in bad.groupBy("violations").count().collect()}
    assert reasons == {("references:customer_key",): 50,
                       ("revenue_identity:net_revenue", "profit_identity:gross_profit"): 100}


def test_gate_and_split_agree_on_what_is_critical(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "k int, v int")
    suite = Suite("s", "fact_x", (C.between("v", 0, None, severity="critical"), C.not_null("v")))
    assert repair.gate(validate(df, suite)).first().decision == "quarantine"
    for path in (None, str(tmp_path / "split")):
        good, bad = repair.quarantine_critical(df, suite, {}, path)
        assert sorted(r.k for r in good.collect()) == [1, 3] and [r.k for r in bad.collect()] == [2]
        assert good.columns == ["k", "v"]
    whole = Suite("s", "fact_x", (C.unique("v", severity="critical"),))
    twice = spark.createDataFrame([(1, 5), (2, 5)], "k int, v int")
    assert repair.gate(validate(twice, whole)).first().decision == "block"


def test_stored_split_reads_the_fact_once(spark, star, tmp_path):
    good, bad = repair.quarantine_critical(star["fact_sales"].limit(2000), consolidated()["fact_sales"], star,
                                           str(tmp_path / "split"))
    for side in (good, bad):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and "Join" not in plan


def test_audit_counts_changes_per_column(star):
    before = defects.inject(star, AS_OF)["dim_customer"]
    changes = repair.rows_changed(before, repair.repair_customers(before, AS_OF), "customer_key",
                                  ["email", "customer_segment", "is_current"])
    assert {r.column_name: r.rows_changed for r in changes.collect()} == {
        "email": 500, "customer_segment": 50, "is_current": 10}
