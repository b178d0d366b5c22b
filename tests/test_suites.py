"""Suites are data: sizes, order, persistence."""

import json

from plumbline.operators import checks as C
from plumbline.operators.checks import Suite, spark_sql_text
from plumbline.plans.suites import consolidated, modular


def test_sizes():
    assert [len(s.checks) for s in consolidated().values()] == [31, 23, 23, 22, 26]
    assert [len(s.checks) for s in modular().values()] == [28, 21, 20, 20, 25]


def test_every_check_equals_its_literal_row():
    """Kind, columns, bounds, tolerance, dimension, issue and severity of both suites, the contracts and the rules."""
    from oracle import data
    from plumbline.operators.contracts import rule_suites
    from plumbline.plans.queries.contracts import SUITES

    for suites, literal in ((consolidated(), data.FULL), (modular(), data.SPLIT), (SUITES, data.CONTRACT),
                            (rule_suites(), data.RULES)):
        assert list(suites) == list(literal)
        for table, suite in suites.items():
            own = [json.loads(json.dumps([c.no, c.kind, c.columns, c.args, c.mostly, c.dimension, c.issue_id, c.predicted,
                                          c.rule_id, c.severity], default=str)) for c in suite.checks]
            rows = [json.loads(json.dumps([c.no, c.kind, c.columns, c.args, c.mostly, c.dimension, c.issue_id, c.predicted,
                                           c.rule_id, c.severity])) for c in literal[table].checks]
            assert own == rows


def test_contract_fields_equal_their_literal_rows():
    from oracle import data
    from plumbline.plans.contracts import TABLES

    for c in TABLES:
        assert [(f.name, f.type, f.name in c.required_columns(), f.name in c.pii_columns(), bool(f.primary))
                for f in c.fields] == [(f.name, f.type, f.required, f.pii, f.primary) for f in data.FIELDS[c.table]]


def test_the_oracle_imports_nothing_from_the_engine():
    import glob
    import os

    folder = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "oracle")
    files = glob.glob(os.path.join(folder, "**", "*.py"), recursive=True)
    assert len(files) > 8 and not any("plumbline" in open(f, encoding="utf-8").read() for f in files)


def test_predicted_failures_cover_all_issues():
    found = {c.issue_id for s in consolidated().values() for c in s.checks if c.predicted == "FAIL"}
    assert found == {f"DQ-00{n}" for n in range(1, 9)}


def test_round_trip_and_stable_numbers():
    suite = consolidated()["dim_customer"]
    assert Suite.from_json(suite.to_json()) == suite
    part = suite.subset(issues=["DQ-002"])
    assert [c.kind for c in part.checks] == ["one_current_row", "distinct_ratio"]
    assert all(suite.checks[c.no - 1] == c for c in part.checks)


def test_reads_expectation_documents():
    doc = {"name": "dim_customer_suite", "expectations": [
        {"type": "expect_column_values_to_match_regex",
         "kwargs": {"column": "email", "regex": "^a$", "mostly": 0.99},
         "meta": {"dimension": "Validity", "predicted": "FAIL, too many"}},
        {"type": "expect_compound_columns_to_be_unique", "kwargs": {"column_list": ["a", "b"]}}]}
    suite = Suite.from_json(json.dumps(doc))
    assert suite.table == "dim_customer"
    assert suite.checks[0] == C.matches("email", "^a$", 0.99, predicted="FAIL", no=1)
    assert suite.checks[1].columns == ("a", "b")


def test_sql_text_of_another_dialect():
    assert spark_sql_text("SELECT 1 FROM {batch} f LEFT JOIN warehouse.dim_date d ON f.k = d.k WHERE x !~ '^A[0-9]+$' "
                          "AND day > CURRENT_DATE") == (
        "SELECT 1 FROM {batch} f LEFT JOIN {dim_date} d ON f.k = d.k WHERE x NOT RLIKE '^A[0-9]+\\\\z' "
        "AND day > {as_of}")
