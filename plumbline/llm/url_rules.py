"""URL filter rules by a sort-merge range join on reversed-host keys; DataFrame functions only.

The canonical key of (host, path) is the host's labels in reverse, a slash, and the path: ``net.example//en/``. All that
starts with a rule's key lies in the interval from the key to the key followed by byte FF, and such intervals nest or
are disjoint. A URL asks under its host and each parent host (as deep as the deepest rule), so that a rule on a parent
host meets the URL's own path.

Sweep over the rules: opening an interval pushes it, closing pops. In columns: a running sum gives the depth after each
boundary, and the rule on top of the stack is the last one that was opened at that depth. Between two boundaries nothing
changes, so sweeping the URLs needs the last boundary at or before each key. Both sweeps deal keys to tasks by range, so
that millions of rules under one top label are many tasks' work. The open stack goes from range to range as short rows:
the depth reached by earlier tasks, and per depth the last rule that they opened; for the URLs, what was on top at the end
of earlier tasks. Equal keys are told apart by host, so one popular key does not have to stay in one task.

Distinct (host, path) pairs are swept; pages join their verdict at the end, where adaptive execution splits a popular
pair. The rule with the longest host and path wins (then the longer host); of rules with the same host and path, block.

Defined cases: a NULL url or one without "://" has empty host and path and gets the default; a rule without host is
ignored; empty tables give no rows or only defaults; repeated rows are judged alike. Other columns are kept, whatever their names,
except that columns named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import ascii_lower
from plumbline.session import durable

DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def labels(host: Column) -> Column:
    """The host's labels, last first."""
    return F.reverse(F.split(host, r"\."))


def canonical(reversed_labels: Column, path: Column) -> Column:
    """Binary, so that it sorts byte by byte and FF comes after every text."""
    return F.concat(F.concat_ws(".", reversed_labels), F.lit("/"), path).cast("binary")


def boundaries(rules: DataFrame) -> DataFrame:
    """(key, top): for every point where an interval of rules (host, path, verdict) opens or closes, the rule that is
    innermost after it, NULL fields if none."""
    given = (rules.where("host is not null and host <> ''")
             .select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))  # block over allow
    spans = given.select(
        canonical(labels(F.col("host")), F.col("path")).alias("key"),
        F.struct((F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
                 F.concat("host", "path").alias("rule"), "verdict").alias("own"))
    events = spans.select(F.explode(F.array(
        F.struct(F.col("key"), F.lit(1).alias("step"), F.col("own")),
        F.struct(F.concat("key", F.lit(b"\xff")).alias("key"), F.lit(-1).alias("step"), F.lit(None).alias("own"))))
        .alias("e")).select("e.*")
    # Stored, since the tasks' numbers are used more than once.
    dealt = durable(events.repartitionByRange("key").withColumn("task", F.spark_partition_id()))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    reached = dealt.groupBy("task").agg(F.sum("step").alias("steps")).select(
        "task", F.coalesce(F.sum("steps").over(earlier), F.lit(0)).alias("reached"))
    in_order = Window.partitionBy("task").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    deep = dealt.join(F.broadcast(reached), "task").withColumn("depth", F.col("reached") + F.sum("step").over(in_order))
    opened = deep.groupBy("task", "depth").agg(F.max_by("own", F.when(F.col("step") == 1, F.col("key"))).alias("own"))
    before = Window.partitionBy("depth").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    carried = opened.select("task", "depth", F.last("own", ignorenulls=True).over(before).alias("carried"))
    at_depth = Window.partitionBy("task", "depth").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    return (deep.withColumn("open", F.last("own", ignorenulls=True).over(at_depth)).join(carried, ["task", "depth"])
            .select("key", F.when(F.col("depth") > 0, F.coalesce("open", "carried")).alias("top")))


def innermost(points: DataFrame, edges: DataFrame) -> DataFrame:
    """The points (key, host, path) with ``top``, the innermost rule around the key (NULL if none)."""
    seen = F.struct(F.col("top"))  # not NULL at a boundary, even where the stack is empty
    rows = (points.select("key", F.lit(1).alias("kind"), "host", "path", F.lit(None).alias("seen"))
            .unionByName(edges.select("key", F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit("").alias("path"),
                                      seen.alias("seen"))))
    # Stored, since the tasks' numbers are used twice.
    dealt = durable(rows.repartitionByRange("key", "kind", "host").withColumn("task", F.spark_partition_id()))
    at_end = dealt.groupBy("task").agg(F.max_by("seen", F.when(F.col("kind") == 0, F.col("key"))).alias("seen"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    carried = at_end.select("task", F.last("seen", ignorenulls=True).over(earlier).alias("carried"))
    sorted_rows = Window.partitionBy("task").orderBy("key", "kind", "host").rowsBetween(Window.unboundedPreceding, 0)
    return (dealt.withColumn("local", F.last("seen", ignorenulls=True).over(sorted_rows)).where("kind = 1")
            .join(F.broadcast(carried), "task")
            .select("host", "path", F.coalesce("local", "carried")["top"].alias("top")))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """The pages (url, ...) with host, path, rule (NULL if none fits) and verdict."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.struct("*").alias("__row__"), host.alias("__host__"), path.alias("__path__"))
    pairs = parsed.select(F.col("__host__").alias("host"), F.col("__path__").alias("path")).distinct()
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    own = labels(F.col("host"))
    depths = F.sequence(F.lit(1), F.least(F.lit(max(deepest, 1)), F.size(own)))
    points = pairs.select("host", "path", F.explode(F.transform(
        depths, lambda n: canonical(F.slice(own, 1, n), F.col("path")))).alias("key"))
    found = innermost(points, boundaries(rules))
    # Stored, so that the join has two plain sides and adaptive execution can split a popular pair.
    best = durable(found.groupBy("host", "path").agg(F.max("top").alias("top"))
                   .select(F.col("host").alias("__host__"), F.col("path").alias("__path__"), "top.rule", "top.verdict")
                   .withColumnsRenamed({"rule": "__rule__", "verdict": "__verdict__"}))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return parsed.join(best, ["__host__", "__path__"]).select(
        *[F.col("__row__").getField(c).alias(c) for c in kept], F.col("__host__").alias("host"), F.col("__path__").alias("path"), F.col("__rule__").alias("rule"),
        F.coalesce("__verdict__", F.lit(default)).alias("verdict"))
