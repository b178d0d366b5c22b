"""Evidence for all failing checks: enough of it, only rows that break the check, the same on a rerun, one scan."""

import datetime as dt
import json

import pytest

from plumbline.operators import checks as C
from plumbline.operators import defects, evidence
from plumbline.operators.checks import Suite
from plumbline.operators.validate import is_row_local, validate, violating_rows
from plumbline.plans.suites import consolidated

AS_OF = dt.date(2026, 4, 29)
KEYS = {"dim_customer": "customer_key", "dim_product": "product_key", "fact_sales": "sales_key"}


def test_every_failing_check_of_the_star(star, mirror_results):
    mirror = defects.inject(star, AS_OF)
    for table, key in KEYS.items():
        suite = consolidated()[table]
        found = evidence.evidence(mirror[table], suite, mirror_results, mirror, key=[key], as_of=AS_OF)
        rows = found.collect()
        assert sorted(map(tuple, rows)) == sorted(map(tuple, found.collect()))
        failing = {r.check_no: r for r in mirror_results.where(f"table_name = '{table}' and status = 'FAIL'").collect()}
        for check in suite.checks:
            mine = [r for r in rows if r.check_no == check.no]
            if check.no not in failing or check.kind == "distinct_ratio":
                assert not mine
                continue
            bad = violating_rows(mirror[table], check, mirror, as_of=AS_OF, hide=[])
            known = {"|".join("" if v is None else str(v) for v in r) for r in
                     bad.select(*([key] if key in bad.columns else check.columns)).distinct().collect()}
            assert {r.row_key for r in mine} <= known
            assert len(mine) == min(20, len(known)) and [r.evidence_no for r in sorted(mine, key=lambda r: r.evidence_no)] == [
                *range(1, len(mine) + 1)]


def rows_with(spark, values):
    return spark.createDataFrame([(i, v) for i, v in values], "id bigint, quantity int")


def test_copies_are_one_piece_and_short_checks_go_on(spark):
    """A third of all rows is one row; the others that fail are far fewer than asked for."""
    df = rows_with(spark, [(7, -1)] * 3_000 + [(100 + i, -2) for i in range(5)] + [(1_000 + i, 1) for i in range(6_000)])
    suite = Suite("s", "t", (C.between("quantity", 0, 10), C.unique("id"), C.not_null("quantity")))
    results = validate(df, suite)
    found = evidence.evidence(df, suite, results, key=["id"]).collect()
    rows = {r.row_key: r.copies for r in found if r.check_type == "between"}
    assert rows == {"7": 3_000, **{str(100 + i): 1 for i in range(5)}}
    groups = [r for r in found if r.check_type == "unique"]
    assert [(r.row_key, json.loads(r.row)) for r in groups] == [("7", {"id": 7, "rows": 3_000})]
    assert {r.check_type for r in found} == {"between", "unique"}


def test_hidden_columns_nulls_and_no_failure(spark):
    df = rows_with(spark, [(None, None), (1, None), (2, 5)])
    suite = Suite("s", "t", (C.not_null("quantity"), C.not_null("id")))
    found = evidence.evidence(df, suite, validate(df, suite), key=["id"], hide=["quantity"]).collect()
    assert {(r.check_no, r.row_key, r.row) for r in found} == {(1, "", "{}"), (1, "1", '{"id":1}'), (2, "", "{}")}
    clean = df.where("id = 2")
    assert evidence.evidence(clean, suite, validate(clean, suite), key=["id"]).collect() == []


def test_share_lets_enough_through():
    assert evidence.share(20, 40) == 1.0 and evidence.share(20, 41) == 1.0
    assert 56 < evidence.share(20, 10 ** 9) * 10 ** 9 < 57


def test_one_scan_for_all_row_checks(spark, small_star, tmp_path):
    mirror = defects.inject(small_star, AS_OF)
    path = str(tmp_path / "fact")
    mirror["fact_sales"].write.parquet(path)
    fact = spark.read.parquet(path)
    suite = consolidated()["fact_sales"]
    results = validate(fact, suite, mirror, as_of=AS_OF)
    failing = {r.check_no for r in results.where("status = 'FAIL'").collect()}
    checks = [c for c in suite.checks if c.no in failing and (is_row_local(c) or c.kind == "references")]
    assert len(checks) >= 3 and any(c.kind == "references" for c in checks)
    marked = evidence.rows_marked(fact, checks, mirror, ["sales_key"], AS_OF)
    plan = evidence._kept(marked, {c.no: 0.1 for c in checks}, 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Window" not in plan


def test_groups_above_the_share_are_not_formed(spark):
    """Key checks of two sets: the pieces are those of all groups, from a few of the rows."""
    df = spark.range(4_000).selectExpr("if(id % 97 = 0, null, id div 2) as a", "cast(id % 1000 as string) as b",
                                       "cast(id % 3 as int) as c", "id % 5 = 0 as flag")
    checks = [c for c in Suite("s", "t", (C.unique("a"), C.duplicate_key("b", "c"), C.compound_unique("a", "b"),
                                          C.has_current_row("b", flag="flag"))).checks]
    shares = {c.no: evidence.share(20, n) for c, n in zip(checks, (4_000, 1_000, 1_000, 800))}
    whole, cut = (evidence.groups_marked(df, checks, shares=s) for s in (None, shares))
    found = [sorted(map(str, evidence._kept(m, shares, 20).collect())) for m in (whole, cut)]
    assert found[0] == found[1] and len(found[0]) >= 40
    assert cut.count() < whole.count() / 2


def test_evidence_of_all_suites_joins_the_lines_once(spark, small_star, monkeypatch):
    """Every scan of the fact would join them anew."""
    from plumbline.plans.queries import checks
    from plumbline.sources import star

    built, scanned = [], []
    monkeypatch.setattr(star, "sales", lambda *_: built.append(1) or small_star["fact_sales"])
    monkeypatch.setattr(checks, "validate_all", lambda w, *a, **k: scanned.append(w["fact_sales"]) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        checks.all_evidence(spark, "")
    assert built == [1] and any("/fact_sales-" in f for f in scanned[0].inputFiles())
