"""One SELECT per check, so that the fused Spark plan is compared with many separate statements."""

from __future__ import annotations

from oracle.star import AS_OF, with_star


def text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def limit(value) -> str:
    if value == "today":
        return f"DATE '{AS_OF}'"
    return f"DATE '{value}'" if isinstance(value, str) else repr(value)


def span(expr: str, args: dict) -> str:
    tests = []
    if args.get("min") is not None:
        tests.append(f"{expr} < {limit(args['min'])}")
    if args.get("max") is not None:
        tests.append(f"{expr} > {limit(args['max'])}")
    return " OR ".join(tests)


def broken(c) -> str:
    """Condition under which one row breaks the check."""
    col, a = (c.columns[0] if c.columns else ""), c.args
    return {
        "not_null": lambda: f"{col} IS NULL",
        "between": lambda: span(col, a),
        "length_between": lambda: span(f"length({col})", a),
        "in_set": lambda: f"{col} NOT IN ({', '.join(repr(v) if isinstance(v, bool) else text(v) for v in a['values'])})",
        "distinct_in_set": lambda: f"{col} NOT IN (true, false)",
        "matches": lambda: f"NOT regexp_matches({col}, {text(a['regex'])})",
        "id_format": lambda: f"NOT regexp_matches({col}, '^{a['prefix']}[0-9]+$')",
        "date_order": lambda: f"{c.columns[1]} < {col}",
        "open_row_sentinel": lambda: f"{col} AND {c.columns[1]} <> DATE '9999-12-31'",
        "margin": lambda: (f"{col} >= {c.columns[1]} AND {c.columns[1]} > 0" if a["guarded"]
                           else f"{col} > {c.columns[1]}"),
        "not_future": lambda: f"{col} > DATE '{AS_OF}'",
        "month_matches": lambda: f"EXTRACT(MONTH FROM {col}) <> {c.columns[1]}",
        "year_matches": lambda: f"EXTRACT(YEAR FROM {col}) <> {c.columns[1]}",
        "revenue_identity": lambda: "abs(net_revenue - (quantity * unit_price - discount_amount)) > 0.01",
        "profit_identity": lambda: "abs(gross_profit - (net_revenue - quantity * unit_cost)) > 0.01",
        "row_rule": lambda: f"NOT ({a['rule']})",
    }[c.kind]()


COLUMN_KINDS = ("between", "length_between", "in_set", "distinct_in_set", "matches")


def counts(c, table: str, prefix: str = "") -> str:
    """SELECT of (ev, un) for one check."""
    col, a = ", ".join(c.columns), c.args
    if c.kind == "row_count":
        return f"SELECT 1 AS ev, CASE WHEN count(*) BETWEEN {a['min']} AND {a['max']} THEN 0 ELSE 1 END AS un FROM {table}"
    if c.kind == "column_order":
        names = ", ".join(text(n) for n in a["names"])
        return (f"SELECT 1 AS ev, CASE WHEN list(column_name) = [{names}] THEN 0 ELSE 1 END AS un "
                f"FROM (DESCRIBE SELECT * FROM {table})")
    if c.kind == "boolean_share":
        return (f"SELECT 1 AS ev, CASE WHEN avg(CASE WHEN {col} THEN 1.0 ELSE 0.0 END) NOT BETWEEN {a['min']} "
                f"AND {a['max']} THEN 1 ELSE 0 END AS un FROM {table}")
    if c.kind == "references":
        return (f"SELECT count(*) AS ev, count(*) FILTER (WHERE k IS NULL) AS un FROM {table} LEFT JOIN "
                f"(SELECT DISTINCT {a['key']} AS k FROM {prefix}{a['table']}) ON {col} = k")
    groups = f"(SELECT {col}, count(*) AS n FROM {table} GROUP BY {col})"
    if c.kind in ("unique", "compound_unique"):
        some = " OR ".join(f"{k} IS NOT NULL" for k in c.columns)
        return (f"SELECT coalesce(sum(n), 0) AS ev, coalesce(sum(n) FILTER (WHERE n > 1), 0) AS un "
                f"FROM {groups} WHERE {some}")
    if c.kind == "duplicate_key":
        return f"SELECT count(*) AS ev, count(*) FILTER (WHERE n > 1) AS un FROM {groups}"
    if c.kind == "dominance":
        return (f"SELECT count(*) AS ev, count(*) FILTER (WHERE n * 1.0 / (SELECT count(*) FROM {table}) > {a['share']}) "
                f"AS un FROM {groups}")
    if c.kind in ("one_current_row", "has_current_row"):
        current = (f"(SELECT {col}, count(*) FILTER (WHERE {a['flag']}) AS n FROM {table} GROUP BY {col})")
        if c.kind == "one_current_row":
            return f"SELECT count(*) FILTER (WHERE n > 0) AS ev, count(*) FILTER (WHERE n > 1) AS un FROM {current}"
        return f"SELECT count(*) AS ev, count(*) FILTER (WHERE n = 0) AS un FROM {current}"
    if c.kind == "distinct_ratio":
        return (f"SELECT 1 AS ev, CASE WHEN count(DISTINCT {col}) * 1.0 / nullif(count({col}), 0) "
                f"NOT BETWEEN {a['min']} AND {a['max']} THEN 1 ELSE 0 END AS un FROM {table}")
    evaluated = f"count({col})" if c.kind in COLUMN_KINDS else "count(*)"
    return f"SELECT {evaluated} AS ev, count(*) FILTER (WHERE {broken(c)}) AS un FROM {table}"


def rows(suite, prefix: str = "") -> list[str]:
    return [f"SELECT {text(suite.table)} AS table_name, {c.no} AS check_no, {text(c.kind)} AS check_type, "
            f"{text(c.column_name)} AS column_name, {text(c.dimension)} AS dimension, "
            f"CAST({text(c.issue_id)} AS VARCHAR) AS issue_id, CAST({text(c.rule_id)} AS VARCHAR) AS rule_id, "
            f"CAST({text(c.severity)} AS VARCHAR) AS severity, CAST({text(c.predicted)} AS VARCHAR) AS predicted, "
            f"CAST({float(c.mostly)} AS DECIMAL(9,8)) AS mostly, ev, un "
            f"FROM ({counts(c, prefix + suite.table, prefix)})" for c in suite.checks]


def results(suites, prefix: str = "") -> str:
    """All checks with share and verdict, as the body of a common table expression."""
    listed = [r for s in suites for r in rows(s, prefix)]
    return ("SELECT table_name, check_no, check_type, column_name, dimension, issue_id, rule_id, severity, predicted, "
            "CAST(mostly AS DOUBLE) AS mostly, CAST(ev AS BIGINT) AS evaluated_count, "
            "CAST(un AS BIGINT) AS unexpected_count, round(un * 100e0 / nullif(ev, 0), 6) AS unexpected_pct, "
            "CASE WHEN mostly = 1 THEN CASE WHEN un = 0 THEN 'PASS' ELSE 'FAIL' END "
            "WHEN CAST(ev - un AS DECIMAL(18,0)) >= mostly * CAST(ev AS DECIMAL(18,0)) THEN 'PASS' ELSE 'FAIL' END "
            "AS status FROM (" + "\nUNION ALL ".join(listed) + ")")


BRIEF = ("table_name, check_no, check_type, column_name, dimension, issue_id, evaluated_count, unexpected_count, "
         "unexpected_pct, status")


def brief(suites, prefix: str = "") -> str:
    return with_star(f"SELECT {BRIEF} FROM results", {"results": results(suites, prefix)})
