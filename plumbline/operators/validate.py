"""Run a suite over a table.

Checks that look at one row at a time, and foreign keys into small dimensions, share one scan and one aggregate.
Checks that need groups share a second scan, of their key columns only: several key sets are grouping sets of it. Every
part yields a few rows; only those are combined.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions import keys as K
from plumbline.functions import predicates as P
from plumbline.operators.checks import Check, Suite

GROUP_KINDS = {"unique", "compound_unique", "duplicate_key", "one_current_row", "has_current_row", "distinct_ratio",
               "dominance"}
COLUMN_KINDS = {"between", "length_between", "in_set", "distinct_in_set", "matches"}


# --- row-local predicates ------------------------------------------------------------------------------------------

def _col(check: Check, at: int = 0) -> Column:
    return F.col(quoted(check.columns[at]))


def _range(check: Check, df: DataFrame, as_of) -> Column:
    column = check.columns[0]
    data_type = df.schema[column].dataType.simpleString()
    low, high = (None if check.args.get(k) is None else P.bound(check.args[k], as_of, data_type)
                 for k in ("min", "max"))
    return P.outside(_col(check), low, high)


def _length(check: Check, df: DataFrame, as_of) -> Column:
    low, high = (None if check.args.get(k) is None else F.lit(check.args[k]) for k in ("min", "max"))
    return P.outside(F.length(_col(check)), low, high)


def _margin(check: Check, df: DataFrame, as_of) -> Column:
    cost, price = _col(check, 0), _col(check, 1)
    return (cost >= price) & (price > 0) if check.args["guarded"] else cost > price


ROW_PREDICATES: dict[str, Callable[[Check, DataFrame, object], Column]] = {
    "not_null": lambda c, df, as_of: _col(c).isNull(),
    "between": _range,
    "length_between": _length,
    "in_set": lambda c, df, as_of: ~_col(c).isin(c.args["values"]),
    "distinct_in_set": lambda c, df, as_of: ~_col(c).isin(c.args["values"]),
    "matches": lambda c, df, as_of: ~_col(c).rlike(P.anchored(c.args["regex"])),
    "id_format": lambda c, df, as_of: ~_col(c).rlike(P.anchored(f"^{c.args['prefix']}[0-9]+$")),
    "date_order": lambda c, df, as_of: _col(c, 1) < _col(c),
    "open_row_sentinel": lambda c, df, as_of: _col(c)
    & (_col(c, 1) != F.lit(c.args["sentinel"]).cast("date")),
    "margin": _margin,
    "not_future": lambda c, df, as_of: _col(c) > P.as_date(as_of),
    "month_matches": lambda c, df, as_of: F.month(_col(c)) != _col(c, 1),
    "year_matches": lambda c, df, as_of: F.year(_col(c)) != _col(c, 1),
    "revenue_identity": lambda c, df, as_of: P.revenue_gap() > F.lit(P.CENT),
    "profit_identity": lambda c, df, as_of: P.profit_gap() > F.lit(P.CENT),
    "row_rule": lambda c, df, as_of: ~F.expr(c.args["rule"]),
}


def violation(check: Check, df: DataFrame, as_of=None, nulls: str = "ignore") -> Column:
    """Boolean column: true on rows that break the check, NULL or false on all others."""
    broken = ROW_PREDICATES[check.kind](check, df, as_of)
    if nulls == "unexpected" and check.kind in COLUMN_KINDS:
        return F.coalesce(broken, F.lit(True))
    return broken


def is_row_local(check: Check) -> bool:
    return check.kind in ROW_PREDICATES


def foreign_key(check: Check) -> K.ForeignKey:
    return K.ForeignKey(check.columns[0], check.args["table"], check.args["key"])


# --- result rows ---------------------------------------------------------------------------------------------------

def _text(value) -> str:
    """A Python value as a SQL string literal, NULL for None."""
    if value is None:
        return "cast(null as string)"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _row(suite: Suite, check: Check, evaluated: str, unexpected: str, observed: str = "null") -> str:
    """One result row as SQL text over the columns of a one-row aggregate: metadata literals plus three values."""
    fields = {
        "table_name": _text(suite.table), "check_no": str(check.no), "check_type": _text(check.kind),
        "column_name": _text(check.column_name), "dimension": _text(check.dimension),
        "issue_id": _text(check.issue_id), "rule_id": _text(check.rule_id), "severity": _text(check.severity),
        "predicted": _text(check.predicted), "mostly": f"{float(check.mostly)!r}D",
        "evaluated_count": f"cast({evaluated} as bigint)", "unexpected_count": f"cast({unexpected} as bigint)",
        "observed_value": f"cast({observed} as string)"}
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _unfold(one_row: DataFrame, rows: list[str]) -> DataFrame:
    """A one-row aggregate as one row per check."""
    return one_row.selectExpr(f"inline(array({', '.join(rows)}))")


def _unless_in(value: str, check: Check, number: Callable[[object], str] = "{!r}D".format) -> str:
    """1 when a value lies outside its band, 0 inside or when there is nothing to judge. Either bound may be missing."""
    tests = [f"{value} {sign} {number(check.args[end])}" for end, sign in (("min", "<"), ("max", ">"))
             if check.args.get(end) is not None]
    return f"if({' or '.join(tests) or 'false'}, 1, 0)"


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def with_status(results: DataFrame) -> DataFrame:
    """Share of unexpected rows and the verdict. The tolerance is compared in decimals, so a boundary passes."""
    return results.selectExpr(
        "*",
        "round(unexpected_count * 100D / nullif(evaluated_count, 0), 6) as unexpected_pct",
        """case when unexpected_count is null then 'NOT_RUN'
                when evaluated_count is null or mostly = 1 then if(unexpected_count = 0, 'PASS', 'FAIL')
                when cast(evaluated_count - unexpected_count as decimal(20,0))
                     >= cast(mostly as decimal(9,8)) * cast(evaluated_count as decimal(20,0)) then 'PASS'
                else 'FAIL' end as status""")


# --- the parts of a suite ------------------------------------------------------------------------------------------

def _one_scan(df: DataFrame, suite: Suite, checks: list[Check], flags: Mapping[str, Column], as_of,
              nulls: str) -> tuple[list[Column], list[str]]:
    """The aggregates of all row-local checks, and the result rows over them."""
    aggregates: dict[str, Column] = {"n": F.count(F.lit(1))}
    rows = []
    for check in checks:
        total, broken, column = "n", f"u{check.no}", check.column_name
        if check.kind == "row_count":
            rows.append(_row(suite, check, "1", _unless_in("n", check, str), "n"))
            continue
        if check.kind == "boolean_share":
            aggregates[broken] = F.count_if(F.col(quoted(column)))
            share = f"double({broken}) / nullif(double(n), 0D)"
            rows.append(_row(suite, check, "1", _unless_in(share, check), f"round({share}, 6)"))
            continue
        if check.kind == "references":
            aggregates[broken] = F.count(F.when(flags[foreign_key(check).flag], 1))
        else:
            aggregates[broken] = F.count(F.when(violation(check, df, as_of, nulls), 1))
        if check.kind in COLUMN_KINDS and nulls == "ignore":
            total = f"c_{column}"
            if total not in aggregates:
                aggregates[total] = F.count(F.col(quoted(column)))
        rows.append(_row(suite, check, quoted(total), broken))
    return [expr.alias(name) for name, expr in aggregates.items()], rows


def _column_order(df: DataFrame, suite: Suite, stored: StructType | None = None) -> list[str]:
    """Schema drift: decided from metadata, no column is read for it. The files' own schema goes before the frame's."""
    names = (stored or df.schema).fieldNames()
    found = _text(",".join(names))
    return [_row(suite, c, "1", str(int(names != list(c.args["names"]))), found)
            for c in suite.checks if c.kind == "column_order"]


def group_sizes(df: DataFrame, keys: Iterable[str], flag: str | None = None) -> DataFrame:
    """Rows per key, combined on the map side, so a hot key adds one row per task to the shuffle."""
    sizes = [F.count(F.lit(1)).alias("n")]
    if flag:
        sizes.append(F.count_if(F.col(quoted(flag))).alias("n_current"))
    return df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(*sizes)


def _grouped(df: DataFrame, suite: Suite, by_keys: Mapping[tuple[str, ...], list[Check]]) -> DataFrame:
    """All checks over key sets. One set is grouped plainly, so that a table bucketed by it needs no shuffle; several
    are grouping sets of one scan, whose groups combine on the map side and carry nothing but counts."""
    names = list(dict.fromkeys(c for keys in by_keys for c in keys))
    flags = list(dict.fromkeys(c.args["flag"] for checks in by_keys.values() for c in checks if "flag" in c.args))
    key = {c: f"_k{i}" for i, c in enumerate(names)}
    current = {f: f"n_current{i}" for i, f in enumerate(flags)}
    sizes = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"_{n}")).alias(n) for n in current.values()]]
    narrow = df.select(*[F.col(quoted(c)).alias(k) for c, k in key.items()],
                       *[F.col(quoted(f)).alias(f"_{n}") for f, n in current.items()])
    if len(by_keys) == 1:
        groups = narrow.groupBy(*key.values()).agg(*sizes).withColumn("set", F.lit(0))
        number = {keys: 0 for keys in by_keys}
    else:
        number = {keys: sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in keys) for keys in by_keys}
        sets = {n: [F.col(key[c]) for c in keys] for keys, n in number.items()}  # equal sets once
        groups = narrow.groupingSets(list(sets.values()), *map(F.col, key.values())).agg(
            F.grouping_id().alias("set"), *sizes)
    checks = [(keys, c) for keys, listed in by_keys.items() for c in listed]
    if any(c.kind == "dominance" for _, c in checks):
        total = df.agg(F.count(F.lit(1)).alias("total")).scalar()  # reads no column
        groups = groups.withColumn("total", total)
    aggregates, rows = [], []
    for keys, check in checks:
        evaluated, broken = f"e{check.no}", f"u{check.no}"
        first, second = _group_measures(check, number[keys], [key[c] for c in keys], current)
        aggregates += [F.expr(first).alias(evaluated), F.expr(second).alias(broken)]
        if check.kind == "distinct_ratio":
            ratio = f"double({broken}) / nullif(double({evaluated}), 0D)"
            rows.append(_row(suite, check, "1", _unless_in(ratio, check), f"round({ratio}, 6)"))
        else:
            rows.append(_row(suite, check, evaluated, broken))
    return _unfold(groups.agg(*aggregates), rows)


def _group_measures(check: Check, number: int, keys: list[str], current: Mapping[str, str]) -> tuple[str, str]:
    """(evaluated, unexpected) of a check, as SQL over the groups of key set ``number``."""
    here = f"set = {number}"
    some_null = " or ".join(f"{k} is null" for k in keys)
    no_key = " and ".join(f"{k} is null" for k in keys)

    def rows_where(condition: str) -> str:
        return f"coalesce(sum(n) filter (where {here} and {condition}), 0)"

    def groups_where(condition: str = "true") -> str:
        return f"count_if({here} and {condition})"

    flagged = current.get(check.args.get("flag"))
    return {
        "unique": lambda: (rows_where(f"not ({some_null})"), rows_where(f"not ({some_null}) and n > 1")),
        "compound_unique": lambda: (rows_where(f"not ({no_key})"), rows_where(f"not ({no_key}) and n > 1")),
        "duplicate_key": lambda: (groups_where(), groups_where("n > 1")),
        "one_current_row": lambda: (groups_where(f"{flagged} > 0"), groups_where(f"{flagged} > 1")),
        "has_current_row": lambda: (groups_where(), groups_where(f"{flagged} = 0")),
        "distinct_ratio": lambda: (rows_where(f"not ({some_null})"), groups_where(f"not ({some_null})")),
        "dominance": lambda: (groups_where(),
                              groups_where(f"double(n) / double(total) > {check.args.get('share')!r}D")),
    }[check.kind]()


def run_query(query: str, df: DataFrame, refs: Mapping[str, DataFrame] | None = None, as_of=None) -> DataFrame:
    """Rows returned by a custom check: Spark SQL over ``{batch}``, ``{table}`` and ``{as_of}``.

    All other braces, such as those of a regular expression, are passed on as they are.
    """
    today = "current_date()" if as_of is None else f"DATE'{as_of}'"
    query = query.replace("{as_of}", today)
    tables = {"batch": df, **{name: t for name, t in (refs or {}).items() if "{" + name + "}" in query}}
    escaped = re.sub(r"\{(\w+)\}|[{}]", lambda m: m[0] if m[1] in tables else re.sub("[{}]", r"\g<0>\g<0>", m[0]), query)
    return df.sparkSession.sql(escaped, **tables)


def _queried(df: DataFrame, suite: Suite, check: Check, refs, as_of) -> DataFrame:
    found = run_query(check.args["query"], df, refs, as_of).agg(F.count(F.lit(1)).alias("u"))
    return _unfold(found, [_row(suite, check, "null", "u")])


# --- entry points --------------------------------------------------------------------------------------------------

def validate(df: DataFrame, suite: Suite, refs: Mapping[str, DataFrame] | None = None, *,
             as_of: dt.date | str | None = None, nulls: str = "ignore", broadcast_bytes: int = K.BROADCAST_BYTES,
             stored: StructType | None = None, near: Mapping[str, K.Lookup] | None = None) -> DataFrame:
    """One row per check: counts, share and PASS/FAIL.

    ``refs`` holds the tables foreign keys and custom queries refer to. ``nulls="unexpected"`` counts NULL as a
    violation in column checks; by default only the not-null check looks at NULL. ``stored`` is the schema of the files
    behind a table that was read with a declared one; the column order is judged on it. ``near`` holds the lookups of
    the suite's foreign keys, where they were measured before.
    """
    if not suite.checks:
        raise ValueError(f"suite {suite.name} has no checks")
    fks = [c for c in suite.checks if c.kind == "references"]
    small = K.lookups([foreign_key(c) for c in fks], refs or {}, broadcast_bytes) if near is None else near
    scan, flags = df, {}
    for fk in map(foreign_key, fks):
        if fk.flag in small and fk.flag not in flags:
            scan = K.mark(scan, fk, small[fk.flag])
            flags[fk.flag] = F.col(fk.flag)

    parts: list[DataFrame] = []
    one_scan = [c for c in suite.checks if is_row_local(c) or c.kind in ("row_count", "boolean_share")
                or (c.kind == "references" and foreign_key(c).flag in small)]
    if one_scan:
        aggregates, rows = _one_scan(scan, suite, one_scan, flags, as_of, nulls)
        parts.append(_unfold(scan.agg(*aggregates), rows + _column_order(df, suite, stored)))
    elif _column_order(df, suite):
        parts.append(_unfold(df.sparkSession.range(0, 1, 1, 1), _column_order(df, suite, stored)))
    for check in fks:
        fk = foreign_key(check)
        if fk.flag not in small:
            parts.append(_unfold(K.orphan_count(df, fk, refs[fk.table]), [_row(suite, check, "n", "orphans")]))
    by_keys: dict[tuple, list[Check]] = {}
    for check in suite.checks:
        if check.kind in GROUP_KINDS:
            by_keys.setdefault(check.columns, []).append(check)
        elif check.kind == "unexpected_rows":
            parts.append(_queried(df, suite, check, refs, as_of))
    if by_keys:
        parts.append(_grouped(df, suite, by_keys))
    return with_status(reduce(DataFrame.unionByName, parts))


def validate_all(tables: Mapping[str, DataFrame], suites: Mapping[str, Suite], *, only: str | None = None,
                 as_of=None, nulls: str = "ignore") -> DataFrame:
    """Results of every suite (or of one table), in one DataFrame."""
    chosen = [s for name, s in suites.items() if only in (None, name)]
    near = K.lookups([replace(foreign_key(c), source=s.table) for s in chosen for c in s.checks if c.kind == "references"],
                     tables)  # every dimension is measured once
    return reduce(DataFrame.unionByName,
                  [validate(tables[s.table], s, tables, as_of=as_of, nulls=nulls,
                            stored=getattr(tables, "stored", {}).get(s.table), near=near) for s in chosen])


def validate_on_write(df: DataFrame, suite: Suite, *, as_of=None,
                      nulls: str = "ignore") -> tuple[DataFrame, Callable[..., DataFrame]]:
    """Run the row-local checks of a suite while the table is being written, without a scan of their own.

    Returns the table to write, and a function that gives the results once the write is done::

        loaded, results = validate_on_write(staged, suite)
        loaded.write.parquet(path)
        results(spark.read.parquet(path), refs).show()

    Given the written table, the results hold every check: those that need groups, other tables or SQL run on it.
    Without it they are reported as NOT_RUN, which a promotion gate takes as not passed.
    """
    rest = [c for c in suite.checks if not (is_row_local(c) or c.kind in ("row_count", "boolean_share", "column_order"))]
    checks = [c for c in suite.checks if c not in rest and c.kind != "column_order"]
    aggregates, rows = _one_scan(df, suite, checks, {}, as_of, nulls)
    seen = Observation(f"{suite.name}_{uuid.uuid4().hex}")

    def results(written: DataFrame | None = None, refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
        counts = seen.get
        schema = ", ".join(f"{quoted(name)} bigint" for name in counts)
        one_row = df.sparkSession.createDataFrame([tuple(counts.values())], schema)
        found = rows + _column_order(df, suite)
        if rest and written is None:
            found = found + [_row(suite, c, "null", "null") for c in rest]
        done = with_status(_unfold(one_row, found)) if found else None
        if rest and written is not None:
            later = validate(written, replace(suite, checks=tuple(rest)), refs, as_of=as_of, nulls=nulls)
            done = done.unionByName(later) if done is not None else later
        return done

    return df.observe(seen, *aggregates), results


def violating_rows(df: DataFrame, check: Check, refs: Mapping[str, DataFrame] | None = None, *, as_of=None,
                   hide: Iterable[str] | None = None) -> DataFrame:
    """The rows that break a check (for key checks: the offending groups), without the hidden columns.

    Unless told otherwise, columns with a classification in their metadata are hidden.
    """
    if hide is None:
        hide = [f.name for f in df.schema.fields if f.metadata.get("classification")]
    if is_row_local(check):
        rows = df.where(violation(check, df, as_of))
    elif check.kind == "references":
        fk = foreign_key(check)
        flagged, flags = K.with_orphan_flags(df, [fk], refs or {})
        rows = flagged.where(flags[fk.flag]).select(*df.columns)
    elif check.kind == "unexpected_rows":
        rows = run_query(check.args["query"], df, refs, as_of)
    elif check.kind in ("unique", "compound_unique", "duplicate_key"):
        known = [F.col(c).isNotNull() for c in check.columns]
        counted = df if check.kind == "duplicate_key" else df.where(reduce(Column.__or__, known))
        rows = group_sizes(counted, check.columns).where("n > 1").withColumnRenamed("n", "dup_count")
    elif check.kind == "one_current_row":
        rows = (group_sizes(df, check.columns, check.args["flag"]).where("n_current > 1")
                .select(*check.columns, F.col("n_current").alias("current_row_count")))
    else:
        raise ValueError(f"{check.kind} has no violating rows")
    return rows.drop(*hide)


def sample_unexpected(df: DataFrame, check: Check, refs=None, *, limit: int = 20, order_by: Iterable[str] = (),
                      as_of=None, hide: Iterable[str] | None = None) -> DataFrame:
    """A few violating rows as evidence."""
    rows = violating_rows(df, check, refs, as_of=as_of, hide=hide)
    return (rows.orderBy(*order_by) if order_by else rows).limit(limit)


def annotated(results: DataFrame, suites: Iterable[Suite]) -> DataFrame:
    """Results with the description and rationale of each check; one short row per check is joined."""
    texts = [(s.table, c.no, c.description, c.rationale) for s in suites for c in s.checks]
    known = results.sparkSession.createDataFrame(
        texts, "table_name string, check_no int, description string, rationale string")
    return results.join(F.broadcast(known), ["table_name", "check_no"], "left")


def ordered(results: DataFrame) -> DataFrame:
    """Results in suite order. They are a few hundred rows, so one partition is enough."""
    return results.repartition(1).sortWithinPartitions("table_name", "check_no")
