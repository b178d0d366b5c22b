"""Evidence rows for all failing checks of a suite at once, by threshold sampling.

How many rows break each check is known from its results. A row gets a draw, a hash of its identity, and is kept for a
check if the draw lies below the share that lets about ``limit`` rows through, with some to spare. That is a filter:
all row checks and foreign keys of a table share one scan and one explode, and nothing is sorted but the few rows that
are left. The ``limit`` smallest draws of each check are its evidence, so a rerun gives the same rows. Key checks show
groups in place of rows; all of them share one grouped scan of the key columns.

Rows of the same identity are one piece of evidence with its number of copies. Where copies or chance leave a check with
fewer pieces than asked for and not all its rows, its share is raised and only such checks are scanned again.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import keys as K
from plumbline.operators.checks import Check, Suite
from plumbline.operators.validate import foreign_key, is_row_local, quoted, run_query, violation
from plumbline.session import durable

EVIDENCE = ["check_no", "check_type", "column_name", "evidence_no", "copies", "row_key", "row"]
DRAW_DIGITS = 15  # hex digits of the draw that are compared with the share
WHOLE = float(16 ** DRAW_DIGITS)
# Key checks that single groups show: what is wrong with a group of n rows, of them n_current flagged.
GROUP_FAULTS = {"unique": "n > 1", "compound_unique": "n > 1", "duplicate_key": "n > 1", "one_current_row": "n_current > 1",
                "has_current_row": "n_current = 0", "dominance": "double(n) / double(total) > {share!r}D"}


def draw(identity: Column) -> Column:
    """A hash of the identity as hex text, evenly spread; other engines compute the same."""
    return F.md5(F.coalesce(identity, F.lit("")))


def value(draw: Column) -> Column:
    """The draw as the number that is compared with the share."""
    return F.conv(F.substring(draw, 1, DRAW_DIGITS), 16, 10).cast("double")


def identity(columns: Iterable[str]) -> Column:
    """Some columns as one text; NULL is empty."""
    return F.concat_ws("|", *[F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in columns])


def share(limit: int, count: int) -> float:
    """The part of ``count`` rows that lets at least ``limit`` through but for rare chance."""
    return 1.0 if count <= 2 * limit else min(1.0, (limit + 6 * limit ** 0.5 + 10) / count)


def _kept(marked: DataFrame, shares: Mapping[int, float], limit: int) -> DataFrame:
    """The smallest draws of each check, from rows (checks, row_key, row): ``checks`` lists the checks that a row breaks."""
    bound = F.create_map(*[v for no, s in shares.items() for v in (F.lit(no), F.lit(s * WHOLE))])
    drawn = marked.where(F.size("checks") > 0).withColumn("draw", draw(F.col("row_key")))
    hits = (drawn.withColumn("value", value(F.col("draw")))
            .select(F.explode(F.filter("checks", lambda no: F.col("value") < bound[no])).alias("check_no"), "draw", "row_key",
                    "row"))
    pieces = hits.groupBy("check_no", "draw").agg(F.count(F.lit(1)).alias("copies"), F.min("row_key").alias("row_key"),
                                                  F.min("row").alias("row"))
    # About ``limit`` and a few more per check; the share bounds them.
    listed = pieces.groupBy("check_no").agg(F.array_sort(F.collect_list(F.struct("draw", "copies", "row_key", "row"))).alias("all"),
                                            F.sum("copies").alias("seen"))
    return listed.select("check_no", "seen", F.posexplode(F.slice("all", 1, limit)).alias("at", "piece")).select(
        "check_no", "seen", (F.col("at") + 1).alias("evidence_no"), "piece.copies", "piece.row_key", "piece.row")


def _complete(found, counts: Mapping[int, int], limit: int, shares: Mapping[int, float]) -> list[DataFrame]:
    """``found(shares)`` for all checks, and again with larger shares for those that are short."""
    parts, open_ = [], dict(shares)
    while open_:
        part = durable(found(open_))
        got = {r["check_no"]: (r["n"], r["seen"]) for r in part.groupBy("check_no").agg(
            F.count(F.lit(1)).alias("n"), F.first("seen").alias("seen")).collect()}  # one row per check
        short = {no: min(1.0, s * 16) for no, s in open_.items()
                 if s < 1.0 and got.get(no, (0, 0))[0] < limit and got.get(no, (0, 0))[1] < counts[no]}
        done = [no for no in open_ if no not in short]
        parts.append(part.where(F.col("check_no").isin(done)))
        open_ = short
    return parts


def _marked(checks: Iterable[tuple[int, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(broken, F.lit(no)) for no, broken in checks]))


def rows_marked(df: DataFrame, checks: list[Check], refs: Mapping[str, DataFrame], key: list[str], as_of=None,
                nulls: str = "ignore", hide: Iterable[str] = ()) -> DataFrame:
    """(checks, row_key, row): which of the row checks and foreign keys each row breaks, from one scan."""
    foreign = list({foreign_key(c).flag: foreign_key(c) for c in checks if c.kind == "references"}.values())
    flagged, flags = K.with_orphan_flags(df, foreign, refs)
    shown = [F.col(quoted(c)) for c in df.columns if c not in set(hide)]
    broken = [(c.no, flags[foreign_key(c).flag] if c.kind == "references" else violation(c, df, as_of, nulls))
              for c in checks]
    return flagged.select(_marked(broken).alias("checks"), identity(key).alias("row_key"),
                          F.to_json(F.struct(*shown)).alias("row"))


def groups_marked(df: DataFrame, checks: list[Check], hide: Iterable[str] = (),
                  shares: Mapping[int, float] | None = None) -> DataFrame:
    """The same for key checks, over the groups of all their key sets: one scan of the key columns.

    Given shares, rows whose group's draw lies above those of all checks are left out before they are grouped. A draw is a
    function of the key, so the groups that are left are whole.
    """
    names = list(dict.fromkeys(c for check in checks for c in check.columns))
    flags = list(dict.fromkeys(c.args["flag"] for c in checks if "flag" in c.args))
    key, current = {c: f"_k{i}" for i, c in enumerate(names)}, {f: f"_f{i}" for i, f in enumerate(flags)}
    narrow = df.select(*[F.col(quoted(c)).alias(k) for c, k in key.items()],
                       *[F.col(quoted(f)).alias(k) for f, k in current.items()])
    sets = list(dict.fromkeys(c.columns for c in checks))
    number = {s: sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in s) for s in sets}
    total = df.agg(F.count(F.lit(1)).alias("total"))
    if shares is not None:
        drawn = []
        for s in sets:
            most = max(shares[c.no] for c in checks if c.columns == s)
            drawn.append(F.lit(True) if most >= 1 else value(draw(identity([key[c] for c in s]))) < F.lit(most * WHOLE))
        narrow = narrow.where(reduce(Column.__or__, drawn))
    groups = narrow.groupingSets([[F.col(key[c]) for c in s] for s in sets], *map(F.col, key.values())).agg(
        F.grouping_id().alias("set"), F.count(F.lit(1)).alias("n"), *[F.count_if(k).alias(f"n{k}") for k in current.values()])
    if any(c.kind == "dominance" for c in checks):
        groups = groups.withColumn("total", total.scalar())
    broken, texts, rows = [], [], []
    for check in checks:
        here = F.col("set") == number[check.columns]
        fault = GROUP_FAULTS[check.kind].format(share=check.args.get("share"))
        if "flag" in check.args:
            fault = fault.replace("n_current", f"n{current[check.args['flag']]}")
        known = F.lit(True)
        if check.kind in ("unique", "compound_unique"):
            known = reduce(Column.__or__, [F.col(key[c]).isNotNull() for c in check.columns])
        broken.append((check.no, here & known & F.expr(fault)))
    for s in sets:
        here = F.col("set") == number[s]
        shown = [F.col(key[c]).alias(c) for c in s if c not in set(hide)]
        texts.append(F.when(here, identity([key[c] for c in s])))
        rows.append(F.when(here, F.to_json(F.struct(*shown, F.col("n").alias("rows")))))
    return groups.select(_marked(broken).alias("checks"), F.coalesce(*texts).alias("row_key"), F.coalesce(*rows).alias("row"))


def evidence(df: DataFrame, suite: Suite, results: DataFrame, refs: Mapping[str, DataFrame] | None = None, *, key: list[str],
             limit: int = 20, as_of=None, nulls: str = "ignore", hide: Iterable[str] | None = None) -> DataFrame:
    """Evidence for every failing check of the suite: ``limit`` different rows (groups, for key checks), or all there are.

    ``results`` are the suite's results on this table; ``key`` names the columns that identify a row. ``row`` is JSON,
    without hidden columns (unless told otherwise, those with a classification). A check that no row shows (a row count,
    a column order, a share or a ratio) has none; neither has one that was not run.
    """
    if hide is None:
        hide = [f.name for f in df.schema.fields if f.metadata.get("classification")]
    hide = set(hide)
    counts = {r["check_no"]: r["unexpected_count"] for r in results.where(
        (F.col("table_name") == suite.table) & (F.col("status") == "FAIL")).select("check_no", "unexpected_count").collect()}
    failing = [c for c in suite.checks if c.no in counts]
    parts: list[DataFrame] = []
    rows = [c for c in failing if is_row_local(c) or c.kind == "references"]
    if rows:
        parts += _complete(
            lambda open_: _kept(rows_marked(df, [c for c in rows if c.no in open_], refs or {}, key, as_of, nulls, hide), open_,
                                limit),
            counts, limit, {c.no: share(limit, counts[c.no]) for c in rows})
    groups = [c for c in failing if c.kind in GROUP_FAULTS]
    if groups:
        # A check over rows in place of groups counts more than its groups; its share is raised where that is too few.
        parts += _complete(lambda open_: _kept(groups_marked(df, [c for c in groups if c.no in open_], hide, open_), open_, limit),
                           counts, limit, {c.no: share(limit, counts[c.no]) for c in groups})
    for check in failing:
        if check.kind == "unexpected_rows":
            found = run_query(check.args["query"], df, refs, as_of)
            shown = F.to_json(F.struct(*[F.col(quoted(c)) for c in found.columns if c not in hide]))
            marked = found.select(F.array(F.lit(check.no)).alias("checks"), identity(found.columns).alias("row_key"),
                                  shown.alias("row"))
            parts += _complete(lambda open_, m=marked: _kept(m, open_, limit), counts, limit,
                               {check.no: share(limit, counts[check.no])})
    known = df.sparkSession.createDataFrame([(c.no, c.kind, c.column_name) for c in suite.checks],
                                            "check_no int, check_type string, column_name string")
    if not parts:
        return known.limit(0).select(*[F.lit(None).cast(t).alias(n) if n not in known.columns else F.col(n) for n, t in zip(
            EVIDENCE, ("int", "string", "string", "int", "bigint", "string", "string"))])
    return reduce(DataFrame.unionByName, parts).join(F.broadcast(known), "check_no").select(*EVIDENCE)
