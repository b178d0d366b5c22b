"""Profiles from stored partial states: a new profile reads the periods that changed, not the table.

The state of a period is one wide row of counts, sums, minima and maxima, and a table of histogram cells (column, value,
rows). Counts, sums and cells merge by addition, minima and maxima by themselves, a mean by its sum and its count; so the
profile of any set of periods is exact and reads states only. A period is read again when its version changes: the folder
a content snapshot keeps it in, or its files' names, sizes and times. Replaced and removed periods need no undoing, since
the index names the states that count.

Two scans of the changed periods, of the profiled columns: one for the wide rows, one for the cells. Both group on the map
side. States lie in a folder per run, and the index, written last, makes them count; a run that is cut short leaves the
former profile. The driver holds one short text per changed period.

Defined cases: no periods give zero counts and NULL minima, as a profile of an empty table does. NULL is a histogram value
of its own. A column without values has a NULL mean.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import profile as P
from plumbline.operators.validate import quoted
from plumbline.session import durable
from plumbline.sources.snapshots import Snapshots

SUM, LEAST, MOST = "sum", "min", "max"


@dataclass(frozen=True)
class Mean:
    """A mean of ``column``, rounded to ``digits``; kept as a sum and a count."""

    column: str
    digits: int = 2
    type: str = "decimal(14,2)"


@dataclass(frozen=True)
class Profile:
    """``measures`` are (aggregate, how its values merge) by name; ``cells`` are the expressions of histograms."""

    measures: Mapping[str, tuple[Column, str]]
    means: Mapping[str, Mean] = field(default_factory=dict)
    cells: Mapping[str, Column] = field(default_factory=dict)

    def parts(self) -> dict[str, tuple[Column, str]]:
        """Everything a wide row holds."""
        held = dict(self.measures)
        for name, mean in self.means.items():
            held[f"{name}__sum"] = (F.sum(quoted(mean.column)), SUM)
            held[f"{name}__n"] = (F.count(quoted(mean.column)), SUM)
        return held

    def states(self, rows: DataFrame, period: Column) -> DataFrame:
        """One wide row per period."""
        return rows.groupBy(period.alias("period")).agg(*[a.alias(n) for n, (a, _) in self.parts().items()])

    def histograms(self, rows: DataFrame, period: Column) -> DataFrame:
        """(period, column_name, value, rows)."""
        cells = F.array(*[F.struct(F.lit(n).alias("column_name"), c.cast("string").alias("value"))
                          for n, c in self.cells.items()])
        return (rows.select(period.alias("period"), F.explode(cells).alias("c"))
                .groupBy("period", "c.column_name", "c.value").agg(F.count(F.lit(1)).alias("rows")))

    def merged(self, states: DataFrame) -> DataFrame:
        """One profile of all given states."""
        how = {SUM: F.sum, LEAST: F.min, MOST: F.max}
        parts = self.parts()
        wide = states.agg(*[how[merge](quoted(n)).alias(n) for n, (_, merge) in parts.items()])
        out = []
        for n, (_, merge) in self.measures.items():
            out.append(F.coalesce(F.col(quoted(n)), F.lit(0)).alias(n) if merge == SUM else F.col(quoted(n)))
        for n, mean in self.means.items():
            share = F.col(quoted(f"{n}__sum")) / F.nullif(F.col(quoted(f"{n}__n")), F.lit(0))
            out.append(F.round(share.cast("decimal(38,6)"), mean.digits).cast(mean.type).alias(n))
        return wide.select(*out)


# Result names of the profiles start with what they are; all others are counts.
WORDS = {"min": LEAST, "earliest": LEAST, "max": MOST, "latest": MOST, "today": MOST}


def table_profile(df: DataFrame, table: str, as_of=None, cells: Mapping[str, Column] | None = None) -> Profile:
    """``profile.whole_profile`` of a table as mergeable parts."""
    aggregates = P.whole_aggregates(df, table, as_of)
    names = df.agg(*aggregates).columns
    means = {n: Mean(n.removeprefix("avg_")) for n in names if n.startswith("avg_")}
    measures = {n: (a, WORDS.get(n.split("_")[0], SUM)) for n, a in zip(names, aggregates) if n not in means}
    return Profile(measures, means, cells or {})


@dataclass(frozen=True)
class ProfileStore:
    """States of one table under ``path``, for one profile."""

    spark: SparkSession
    path: str
    profile: Profile

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def index(self) -> DataFrame:
        """(period, version, made_in, action) of the last run; REMOVED periods are listed, but do not count."""
        stored = self._read("index")
        if stored is None:
            return self.spark.createDataFrame([], "period string, version string, made_in int, action string, run int")
        last = stored.agg(F.max("run")).first()[0]
        return stored.where((F.col("run") == last) & F.col("period").isNotNull())

    def _last(self) -> int:
        stored = self._read("index")
        return 0 if stored is None else stored.agg(F.max("run")).first()[0]

    def refresh(self, versions: DataFrame, read: Callable[[Sequence[str]], DataFrame], period: Column) -> DataFrame:
        """Bring the states up to date with (period, version) and return the index.

        ``read`` gives the rows of the named periods, and only those are read; ``period`` is the text that names a row's.
        """
        known = self.index().where("action <> 'REMOVED'").select("period", "version", "made_in")
        now = durable(versions.select("period", F.col("version").cast("string").alias("version"))
                      .join(known, ["period", "version"], "left"))
        wanted = [r["period"] for r in now.where("made_in IS NULL").select("period").collect()]
        run = self._last() + 1
        if wanted:
            rows = read(wanted)
            self._write(self.profile.states(rows, period), "states", run)
            if self.profile.cells:
                self._write(self.profile.histograms(rows, period), "cells", run)
        listed = now.select("period", "version", F.coalesce("made_in", F.lit(run)).alias("made_in"),
                            F.when(F.col("made_in").isNull(), "READ").otherwise("KEPT").alias("action"))
        gone = known.join(now, "period", "left_anti").select("period", "version", "made_in", F.lit("REMOVED").alias("action"))
        marker = self.spark.range(1).selectExpr("cast(null as string) as period", "cast(null as string) as version",
                                                "cast(null as int) as made_in", "cast(null as string) as action")
        self._write(listed.unionByName(gone).unionByName(marker).coalesce(1), "index", run)
        return self.index()

    def _write(self, df: DataFrame, name: str, run: int) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/{name}/run={run}"))

    def _live(self, name: str, periods: Sequence[str] | None) -> DataFrame | None:
        stored = self._read(name)
        if stored is None:
            return None
        live = self.index().where("action <> 'REMOVED'").select("period", F.col("made_in").alias("run"))
        live = live if periods is None else live.where(F.col("period").isin(list(periods)))
        return stored.join(live, ["period", "run"], "left_semi")

    def whole(self, periods: Sequence[str] | None = None) -> DataFrame:
        """The profile of all periods, or of some: one row, from states only."""
        states = self._live("states", periods)
        if states is None:
            parts = self.profile.parts()
            states = self.spark.createDataFrame([], ", ".join(f"`{n}` bigint" for n in parts))
        return self.profile.merged(states)

    def histogram(self, column: str, periods: Sequence[str] | None = None) -> DataFrame:
        """(value, row_count) of a profiled expression, from states only."""
        cells = self._live("cells", periods)
        if cells is None:
            return self.spark.createDataFrame([], "value string, row_count bigint")
        return (cells.where(F.col("column_name") == column).groupBy("value")
                .agg(F.sum("rows").alias("row_count")))


def snapshot_versions(copies: Snapshots, version: int | None = None) -> DataFrame:
    """(period, version) of a content snapshot: a period keeps its version as long as its rows are the same."""
    return copies.manifest(version).select("period", F.col("stored_in").cast("string").alias("version"))


def file_versions(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(period, version) of a table in folders by ``column``, from its files' names, sizes and times; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    mark = F.xxhash64("path", "length", "modificationTime")
    return files.groupBy(F.col(quoted(column)).cast("string").alias("period")).agg(
        F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.bit_xor(mark)).alias("version"))
