"""Verdicts: clean control, injected defects, edge rows, and the shape of the plans."""

import datetime as dt

import pytest

from plumbline.functions import keys as K
from plumbline.operators import checks as C
from plumbline.operators import defects, repair
from plumbline.operators.checks import Suite
from plumbline.operators.integrity import orphan_report
from plumbline.operators.validate import (annotated, sample_unexpected, validate, validate_all, validate_on_write,
                                          violating_rows)
from plumbline.plans.suites import consolidated, modular

AS_OF = dt.date(2026, 4, 29)


def failed(results):
    return {(r.table_name, r.check_type, r.column_name): r.unexpected_count for r in results.collect()
            if r.status == "FAIL"}


def one(df, *checks, refs=None, **options):
    rows = validate(df, Suite("s", "t", checks), refs, **options).collect()
    return {r.check_no: r for r in rows}


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_clean_star_passes_every_check(star):
    assert failed(validate_all(star, consolidated(), as_of=AS_OF)) == {}


def test_clean_star_modular_differs_only_in_the_id_prefix(star):
    assert set(failed(validate_all(star, modular(), as_of=AS_OF))) == {("dim_product", "id_format", "product_id")}


def test_injected_defects_fail_exactly_where_predicted(mirror_results):
    found = failed(mirror_results)
    assert found == {
        ("dim_customer", "not_null", "email"): 300,
        ("dim_customer", "one_current_row", "customer_id"): 10,
        ("dim_customer", "distinct_ratio", "customer_id"): 1,
        ("dim_customer", "matches", "email"): 200,
        ("dim_customer", "in_set", "customer_segment"): 50,
        ("dim_product", "between", "list_price"): 15,
        ("dim_product", "margin", "cost_price,list_price"): 10,
        ("fact_sales", "between", "quantity"): 100,
        ("fact_sales", "references", "customer_key"): 50,
        ("fact_sales", "revenue_identity", "net_revenue"): 100,
        ("fact_sales", "profit_identity", "gross_profit"): 100,
    }


def test_unguarded_margin_also_counts_the_zero_priced(star):
    mirror = defects.inject(star, AS_OF)
    suite = modular()["dim_product"].subset(kinds=["margin"])
    assert validate(mirror["dim_product"], suite).first().unexpected_count == 25


def test_defect_audit(star):
    rows = defects.affected_rows(defects.inject(star, AS_OF)).collect()
    # The D6 audit counts cost > price without a guard, so the 15 products priced at zero by D5 show up as well.
    assert {r.defect: r.rows for r in rows} == {**{d.name: d.expected for d in defects.DEFECTS}, "D6": 25}


def test_all_defects_are_detected_and_none_is_missed(mirror_results):
    assert defects.detection_rate(mirror_results).first().detection_rate == 100.0
    outcomes = {r.outcome for r in defects.outcome(mirror_results).select("outcome").distinct().collect()}
    assert outcomes == {"MATCH", "UNPREDICTED_FAIL"}  # the two identities broken by the injected quantities


def test_empty_table_passes_all_but_the_row_count(star):
    empty = star["fact_sales"].limit(0)
    found = failed(validate(empty, consolidated()["fact_sales"], star, as_of=AS_OF))
    assert set(found) == {("fact_sales", "row_count", "")}


def test_null_is_only_seen_by_not_null(spark):
    df = spark.createDataFrame([(None,)] * 3, "c string")
    got = one(df, C.not_null("c"), C.length_between("c", 1, 2), C.in_set("c", ["a"]), C.matches("c", "^a$"),
              C.unique("c"))
    assert got[1].unexpected_count == 3
    assert [got[i].evaluated_count for i in (2, 3, 4, 5)] == [0, 0, 0, 0]
    assert all(got[i].status == "PASS" for i in (2, 3, 4, 5))
    strict = one(df, C.matches("c", "^a$"), nulls="unexpected")
    assert (strict[1].evaluated_count, strict[1].unexpected_count) == (3, 3)


def test_mostly_passes_exactly_at_the_boundary(spark):
    df = spark.createDataFrame([(None if i < 1 else "x",) for i in range(100)], "c string")
    assert one(df, C.not_null("c", 0.99))[1].status == "PASS"
    df = spark.createDataFrame([(None if i < 2 else "x",) for i in range(100)], "c string")
    assert one(df, C.not_null("c", 0.99))[1].status == "FAIL"


def test_bounds_are_inclusive_and_exact(spark):
    df = spark.createDataFrame([("0.01",), ("0.00",), ("100000.00",), ("100000.01",)], "p string").selectExpr(
        "cast(p as decimal(12,2)) as p")
    assert one(df, C.between("p", 0.01, 100_000))[1].unexpected_count == 2


def test_trailing_newline_is_not_the_end_of_an_id(spark):
    df = spark.createDataFrame([("CUS12",), ("CUS12\n",), ("XCUS12",)], "id string")
    assert one(df, C.id_format("id", "CUS"))[1].unexpected_count == 2
    assert one(df, C.matches("id", "^CUS[0-9]+$"))[1].unexpected_count == 2


def test_today_as_bound(spark):
    df = spark.sql("select explode(array(date '2026-04-29', date '2026-04-30')) as d")
    got = one(df, C.between("d", "2000-01-01", "today"), C.not_future("d"), as_of=AS_OF)
    assert [got[1].unexpected_count, got[2].unexpected_count] == [1, 1]


def test_compound_key_skips_rows_without_any_part(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (None, None), (2, 2)], "a int, b int")
    got = one(df, C.compound_unique("a", "b"), C.duplicate_key("a", "b"))
    assert (got[1].evaluated_count, got[1].unexpected_count) == (3, 2)
    assert got[2].unexpected_count == 2  # SQL grouping counts the all-null group as well


@pytest.mark.parametrize("bound", [K.BROADCAST_BYTES, 0])
def test_foreign_keys_with_null_and_duplicate_dimension_keys(spark, bound):
    fact = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "k bigint")
    dim = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    got = one(fact, C.references("k", "dim", "k"), refs={"dim": dim}, broadcast_bytes=bound)
    assert (got[1].evaluated_count, got[1].unexpected_count) == (5, 2)


def test_orphan_flags_agree_on_all_three_ways(spark, monkeypatch):
    fact = spark.range(1000).selectExpr("id", "if(id < 400, 7, if(id % 10 = 0, null, id)) as k")
    dim = spark.range(900).selectExpr("id as k").where("k != 7")
    key = [K.ForeignKey("k", "dim", "k")]

    def count(limit):
        flagged, flags = K.with_orphan_flags(fact, key, {"dim": dim}, limit)
        assert flagged.count() == 1000
        return flagged.where(flags["missing_k_dim"]).count()

    small = count(K.BROADCAST_BYTES)
    few_missing = count(10_000)   # the dimension is too large, the missing keys are not
    neither = count(0)            # plain join
    assert small == few_missing == neither == 400 + 60 + 90


def test_several_keys_into_one_table_and_several_tables(spark):
    a = spark.createDataFrame([(1, 9), (2, 1), (8, 9)], "ordered int, shipped int")
    b = spark.createDataFrame([(7,), (1,)], "day int")
    tables = {"a": a, "b": b, "days": spark.createDataFrame([(1,), (2,)], "k int")}
    keys = [K.ForeignKey("ordered", "days", "k", "R1", source="a"), K.ForeignKey("shipped", "days", "k", "R2", source="a"),
            K.ForeignKey("day", "days", "k", "R3", source="b")]
    for limit in (K.BROADCAST_BYTES, 0):
        rows = {r.check_name: (r.rule_id, r.orphan_count) for r in orphan_report(tables, keys, limit).collect()}
        assert rows == {"a.ordered -> days": ("R1", 1), "a.shipped -> days": ("R2", 2), "b -> days": ("R3", 1)}
    flagged, flags = K.with_orphan_flags(a, keys[:2], tables)
    assert flagged.where(flags[keys[0].flag] & flags[keys[1].flag]).count() == 1


def test_offending_groups_leave_out_unknown_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    groups = violating_rows(df, C.unique("k")).collect()
    assert [(r.k, r.dup_count) for r in groups] == [(1, 2)]
    assert violating_rows(df, C.duplicate_key("k")).count() == 2


def test_custom_sql_sees_other_tables_and_the_day(star):
    suite = Suite("s", "dim_store", (
        C.unexpected_rows("SELECT * FROM {batch} WHERE opening_date > {as_of}"),
        C.unexpected_rows("SELECT s.store_key FROM {batch} s LEFT ANTI JOIN {dim_date} d ON s.store_key = d.date_key")))
    got = {r.check_no: r for r in validate(star["dim_store"], suite, star, as_of="2010-05-31").collect()}
    assert (got[1].unexpected_count, got[2].unexpected_count) == (200, 200)


def test_boolean_share_and_dominance(spark):
    df = spark.range(100).selectExpr("id < 30 as w", "if(id < 71, 'a', 'b') as t")
    got = one(df, C.boolean_share("w", 0.25, 0.32), C.dominance("t", 0.70), C.dominance("t", 0.75),
              C.boolean_share("w", 0.31, 0.32))
    assert [got[i].status for i in (1, 2, 3, 4)] == ["PASS", "FAIL", "PASS", "FAIL"]


def test_customer_without_a_current_row(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", False), ("c", True), ("c", True)],
                               "customer_id string, is_current boolean")
    got = one(df, C.one_current_row("customer_id"), C.has_current_row("customer_id"))
    assert (got[1].unexpected_count, got[2].unexpected_count) == (1, 1)


def test_schema_drift_is_found_without_reading(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert one(df, C.column_order("a", "b"))[1].status == "FAIL"
    assert one(df, C.column_order("b", "a"))[1].status == "PASS"


def test_sample_is_limited_and_hides_columns(star):
    mirror = defects.inject(star, AS_OF)
    check = next(c for c in consolidated()["dim_customer"].checks if c.kind == "matches")
    sample = sample_unexpected(mirror["dim_customer"], check, limit=5, order_by=["customer_key"], hide=["email"])
    assert [r.customer_key for r in sample.collect()] == [2001, 2002, 2003, 2004, 2005]
    assert "email" not in sample.columns


def test_row_checks_and_small_foreign_keys_share_one_scan(spark, star, tmp_path):
    path = str(tmp_path / "fact")
    star["fact_sales"].limit(1000).write.parquet(path)
    fact = spark.read.parquet(path)
    kinds = ["not_null", "between", "length_between", "references", "revenue_identity", "profit_identity", "row_count"]
    text = plan(validate(fact, consolidated()["fact_sales"].subset(kinds=kinds), star))
    assert text.count("sales_key#") and text.count("Relation [") == 1
    assert "Join LeftOuter" in text and "rightHint=(strategy=broadcast)" in text


def test_one_grouping_serves_all_checks_of_a_key(spark, star, tmp_path):
    path = str(tmp_path / "dim")
    star["dim_customer"].write.parquet(path)
    suite = consolidated()["dim_customer"].subset(kinds=["one_current_row", "distinct_ratio"])
    assert plan(validate(spark.read.parquet(path), suite)).count("Relation [") == 1


def test_large_dimension_is_never_broadcast_by_hint(star):
    key = K.ForeignKey("customer_key", "dim_customer", "customer_key")
    text = plan(K.orphan_count(star["fact_sales"], key, star["dim_customer"]))
    assert "strategy=broadcast" not in text
    assert "Aggregate [customer_key" in text  # rows are reduced to keys before the join


def test_checks_during_a_write_agree_with_a_separate_run(spark, star, tmp_path):
    sales = defects.inject(star, AS_OF)["fact_sales"]
    suite = consolidated()["fact_sales"]
    loaded, results = validate_on_write(sales, suite)
    loaded.write.parquet(str(tmp_path / "fact"))
    during = {r.check_no: (r.evaluated_count, r.unexpected_count, r.status) for r in results().collect()
              if r.status != "NOT_RUN"}
    after = {r.check_no: (r.evaluated_count, r.unexpected_count, r.status)
             for r in validate(sales, suite.subset(numbers=during)).collect()}
    assert during == after and len(during) > 15


def test_last_resort_join_splits_the_hot_key(spark):
    fact = spark.range(0, 300_000, 1, 8).selectExpr("id", "if(id % 3 = 0, 7, id) as k", "repeat('x', 50) as payload")
    dim = spark.range(0, 250_000).selectExpr("id as k")
    tuned = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}
    for name, value in tuned.items():
        spark.conf.set(name, value)
    try:
        flagged, flags = K.with_orphan_flags(fact, [K.ForeignKey("k", "dim", "k")], {"dim": dim}, 0)
        # whole rows pass through, as they do into a quarantine table
        out = flagged.select("id", "payload", flags["missing_k_dim"].alias("orphan"))
        rows = out.collect()
        assert len(rows) == 300_000
        assert sum(r.orphan for r in rows) == sum(1 for i in range(250_000, 300_000) if i % 3)
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in tuned:
            spark.conf.unset(name)


def test_unrun_checks_have_a_row_and_stop_the_gate(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string")
    suite = Suite("s", "fact_x", (C.not_null("k"), C.unique("k"), C.unique("v"), C.column_order("k", "v")))
    loaded, results = validate_on_write(df, suite)
    path = str(tmp_path / "t")
    loaded.write.parquet(path)
    assert {r.check_no: r.status for r in results().collect()} == {1: "PASS", 2: "NOT_RUN", 3: "NOT_RUN", 4: "PASS"}
    assert repair.gate(results()).first().decision == "block"
    done = results(spark.read.parquet(path))
    assert {r.check_no: r.status for r in done.collect()} == {1: "PASS", 2: "PASS", 3: "FAIL", 4: "PASS"}
    only_keys = Suite("s", "fact_x", (C.unique("k"),))
    loaded, results = validate_on_write(df, only_keys)
    loaded.write.parquet(str(tmp_path / "u"))
    assert [r.status for r in results().collect()] == ["NOT_RUN"]


def test_custom_sql_keeps_other_braces(spark):
    df = spark.createDataFrame([("AB",), ("ABC",), ("a}{b",)], "s string")
    for pattern, bad in (("^[A-Z]{2}$", 2), ("[A-Z]{2,}", 1), ("^[^{}]+$", 1)):
        suite = Suite("s", "t", (C.unexpected_rows(f"SELECT * FROM {{batch}} WHERE NOT s RLIKE '{pattern}'"),))
        assert validate(df, suite).first().unexpected_count == bad


def test_one_sided_bounds_and_quoted_names(spark):
    df = spark.createDataFrame([(1, "b", True), (1, "d", False), (None, "f", False)], "`a b` int, `t.x` string, `is on` boolean")
    suite = Suite("s", "t", (
        C.row_count(low=3), C.row_count(high=2), C.distinct_ratio("a b", low=0.6), C.distinct_ratio("a b", high=0.6),
        C.between("t.x", "c", None), C.between("t.x", None, "c"), C.unique("a b"), C.compound_unique("a b", "t.x"),
        C.one_current_row("t.x", flag="is on"), C.boolean_share("is on", 0.5, 1.0), C.not_null("a b")))
    got = {r.check_no: (r.unexpected_count, r.status) for r in validate(df, suite).collect()}
    assert got == {1: (0, "PASS"), 2: (1, "FAIL"), 3: (1, "FAIL"), 4: (0, "PASS"), 5: (1, "FAIL"), 6: (2, "FAIL"),
                   7: (2, "FAIL"), 8: (0, "PASS"), 9: (0, "PASS"), 10: (1, "FAIL"), 11: (1, "FAIL")}


def test_all_key_sets_share_one_scan(spark, star, tmp_path):
    path = str(tmp_path / "fact")
    star["fact_sales"].limit(1000).write.parquet(path)
    df = spark.read.parquet(path)
    suite = Suite("s", "fact_sales", (
        C.not_null("order_id"), C.unique("sales_key"), C.duplicate_key("order_id", "order_line_num"),
        C.compound_unique("order_line_num", "order_id"), C.distinct_ratio("customer_key", 0.0, 1.0), C.unique("order_id")))
    results = validate(df, suite)
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # one for rows, one for all keys
    got = {r.check_no: r.unexpected_count for r in results.collect()}
    assert (got[2], got[3], got[4]) == (0, 0, 0) and got[6] == 1000 - df.groupBy("order_id").count().where("count = 1").count()


def test_metadata_reaches_results_and_files(spark):
    raw = {"name": "t_suite", "expectations": [{"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "k"},
                                               "meta": {"rationale": "keys join", "description": "x"}, "description": "k is set"}]}
    suite = Suite.from_json(Suite.from_json(__import__("json").dumps(raw)).to_json())
    assert (suite.checks[0].rationale, suite.checks[0].description) == ("keys join", "k is set")
    row = annotated(validate(spark.range(1).toDF("k"), suite), [suite]).first()
    assert (row.rationale, row.description) == ("keys join", "k is set")
