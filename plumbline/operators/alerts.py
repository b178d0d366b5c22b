"""Alert rules evaluated over metric rows. Delivery is somebody else's job; this decides what fires."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import durable


@dataclass(frozen=True)
class AlertRule:
    alert_id: str
    name: str
    condition: str
    severity: str
    cooldown_minutes: int


# Alert ids, conditions, severities and cool-down times.
RULES = (
    AlertRule("ALT-001", "critical_quality_score_failure", "overall_quality_score < 0.95", "critical", 60),
    AlertRule("ALT-002", "referential_integrity_break", "orphan_record_count > 0", "critical", 0),
    AlertRule("ALT-003", "freshness_sla_breach", "data_age_hours > 24", "high", 120),
    AlertRule("ALT-004", "volume_anomaly_low", "daily_row_count < rolling_7d_avg * 0.5", "high", 60),
    AlertRule("ALT-005", "quality_trend_declining", "score_3day_trend < -0.01", "medium", 1440),
    AlertRule("ALT-006", "scd2_duplicate_current_rows", "scd2_duplicate_count > 0", "critical", 0),
)


def evaluate(metrics: DataFrame, rules: Iterable[AlertRule] = RULES, log: DataFrame | None = None,
             at: str = "evaluated_at", series: Iterable[str] = ()) -> DataFrame:
    """One row per metric row and rule: triggered, suppressed (still cooling down), fired.

    ``log`` holds (series, alert_id, fired_at) of alerts sent before; only entries younger than the longest cool-down,
    counted from the first evaluation, are read. An alert that fires in this run suppresses later ones of the run as well.
    A cool-down of 0 fires every time. With ``series``, every series of metrics has cool-downs of its own.
    """
    rules, series = list(rules), list(series)
    rows = [f"named_struct('alert_id', '{r.alert_id}', 'name', '{r.name}', 'severity', '{r.severity}', "
            f"'cooldown_minutes', {r.cooldown_minutes}, 'triggered', coalesce({r.condition}, false))" for r in rules]
    judged = durable(metrics.selectExpr(*series, at, f"inline(array({', '.join(rows)}))"))
    own = {f"__g{i}": F.col(c) for i, c in enumerate(series)}  # clash with no name used on the way
    group = [*own, "alert_id"]
    origin = F.lit("1970-01-01 00:00:00").cast(metrics.schema[at].dataType)
    time = lambda column: F.timestamp_diff("MICROSECOND", origin, F.col(column).cast(metrics.schema[at].dataType))
    hits = (judged.where(F.col("triggered") & (F.col("cooldown_minutes") > 0) & F.col(at).isNotNull())
            .withColumns(own).select(*group, time(at).alias("t"), (F.col("cooldown_minutes") * F.lit(60_000_000).cast("bigint")).alias("cool"))
            .distinct())
    if log is not None:
        longest = max(r.cooldown_minutes for r in rules)
        since = metrics.agg((F.min(at) - F.make_dt_interval(mins=F.lit(longest))).alias("since")).scalar()
        sent = log.where(F.col("fired_at") >= since).withColumns(own).select(*group, time("fired_at").alias("s")).distinct()
        hits = not_cooling(hits, sent, group)
    fired = renamed(first_after_cooling(hits, group).withColumn("_new", F.lit(True)), [*group, "t"])
    known = judged.withColumns({**own, "__t": time(at)}).join(
        fired.withColumnRenamed("_r_t", "_r___t"), equal([*group, "__t"]), "left")
    new = F.col("triggered") & (F.coalesce("_new", F.lit(False)) | (F.col("cooldown_minutes") == 0))
    return (known.withColumn("fired", new).withColumn("suppressed", F.col("triggered") & ~F.col("fired"))
            .select(*series, at, "alert_id", "name", "severity", "cooldown_minutes", "triggered", "suppressed", "fired"))


# --- cooling down --------------------------------------------------------------------------------------------------
# Times are cut into blocks as long as the cool-down. Whatever can suppress an evaluation, and whatever fires next after
# one, is at most two blocks away, so blocks are joined with their neighbours and no alert has to sit in one task.

def renamed(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The rows as the right side of a join by ``equal``."""
    return rows.withColumnsRenamed({c: f"_r_{c}" for c in columns})


def equal(columns: Iterable[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns])


def _block(time: Column) -> Column:
    return F.floor(time / F.col("cool")).cast("bigint")


def not_cooling(hits: DataFrame, sent: DataFrame, group: list[str]) -> DataFrame:
    """The triggered evaluations (group, t, cool) without those less than a cool-down after an alert sent before."""
    cool = renamed(hits.select(*group, "cool").distinct(), group)
    blocks = (sent.join(cool, equal(group)).withColumn("block", _block(F.col("s")))
              .select(*group, "s", F.explode(F.array("block", F.col("block") + 1)).alias("block")))
    keys = [*group, "block"]
    return hits.withColumn("block", _block(F.col("t"))).join(
        renamed(blocks, keys), equal(keys) & (F.col("s") <= F.col("t")) & (F.col("t") < F.col("s") + F.col("cool")),
        "left_anti").drop("block")


def first_after_cooling(hits: DataFrame, group: list[str]) -> DataFrame:
    """(group, t) of those that fire: the first, then each time the first at or after the cool-down of the one before.

    An evaluation with none in the cool-down before it fires. Every other one that fires is the successor of one that
    does: the first at or after its time plus the cool-down. So what fires is a chain of successors from each of the
    former; pointers are doubled, and a chain of n links takes about log2(n) joins.
    """
    placed = durable(hits.select(*group, "t", "cool", _block(F.col("t")).alias("block")))
    ends = placed.groupBy(*group, "block").agg(F.min("t").alias("least"), F.max("t").alias("most"))
    in_block = Window.partitionBy(*group, "block")
    keys = [*group, "block"]

    def beside(rows: DataFrame, step: int, value: str, name: str) -> DataFrame:
        """The least or greatest time of the block ``step`` blocks on."""
        other = renamed(ends.select(*group, (F.col("block") - step).alias("block"), F.col(value).alias(name)), keys)
        return rows.join(other, equal(keys), "left").drop(*[f"_r_{c}" for c in keys])

    before = placed.withColumn("prior", F.lag("t").over(in_block.orderBy("t")))
    before = beside(before, -1, "most", "last_before")
    starts = before.where(F.coalesce(F.col("t") - F.coalesce("prior", "last_before") >= F.col("cool"), F.lit(True)))
    # Successors: each time plus its cool-down is put among the times of the next block.
    asked = placed.select(*group, (F.col("block") + 1).alias("block"), (F.col("t") + F.col("cool")).alias("place"),
                          F.lit(0).alias("kind"), F.col("t"))
    there = placed.select(*group, "block", F.col("t").alias("place"), F.lit(1).alias("kind"), F.col("t"))
    on = in_block.orderBy("place", "kind").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    found = (asked.unionByName(there).withColumn("found", F.first(F.when(F.col("kind") == 1, F.col("t")), ignorenulls=True).over(on))
             .where("kind = 0"))
    links = beside(found, 1, "least", "later").select(*group, "t", F.coalesce("found", "later").alias("next"))
    jump = durable(links.where("next is not null"))
    reached = durable(starts.select(*group, "t"))
    while jump.take(1):
        ahead = renamed(jump, [*group, "t", "next"])
        follow = lambda rows, column: rows.join(ahead, equal(group) & (F.col(column) == F.col("_r_t")))
        reached = durable(reached.unionByName(follow(reached, "t").select(*group, F.col("_r_next").alias("t"))).distinct())
        jump = durable(follow(jump, "next").select(*group, "t", F.col("_r_next").alias("next")))
    return reached
