"""Snapshots by content: a later snapshot of a table copies only the periods whose rows changed.

The content of a period is told by its number of rows and by the sum and the exclusive or of its row hashes. None of them
depends on the order of rows or on how they lie in files, and all combine on the map side, so a hot period is one row per
task in the shuffle. A snapshot takes them of the source in one scan, copies the periods that the last snapshot does not
have, and takes them again of what was written: ``agrees`` tells that copy and source have the same rows.

Copies are never changed. Each lies in the folder of the snapshot that wrote it, and a manifest, written last, names the
folder of every period. So a snapshot that was cut short leaves the earlier ones as they are, and all of them stay readable.

Defined cases: an empty table has an empty manifest and reads as no rows. Rows equal in everything are counted. A NULL
period and an empty one share a folder; no row changes by that. Another schema copies everything. Equal content in another
order or layout copies nothing. A period whose proof failed is copied again by the next snapshot. Columns named as the two
folder levels are refused. The driver holds one short text per period.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.validate import quoted
from plumbline.session import durable
from plumbline.sources.registry import Warehouse

FEW = 16  # so many periods, or fewer, are copied without a shuffle: each task writes at most that many files
PERIOD, VERSION = "snapshot_period", "snapshot_version"  # the two folder levels
CONTENT = ("rows", "hash_sum", "hash_xor")
MANIFEST = ("period string, rows bigint, hash_sum decimal(38,0), hash_xor bigint, stored_in int, agrees boolean, "
            "action string, schema string")


def flat(column: Column, kind: T.DataType) -> Column:
    """A column that can be hashed: nested values as text, since hash functions pass over NULLs within them."""
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(column, {"ignoreNullFields": "false"})
    return column


def fast_hash(columns: Sequence[Column]) -> Column:
    """A 64-bit hash; NULLs are told by flags, since the function passes over them."""
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def portable_hash(columns: Sequence[Column]) -> Column:
    """A hash that other engines compute as well, at a higher price: 60 bits of the MD5 of the values as text.

    Each value is its number of characters, a colon and its text, or ``-`` for NULL.
    """
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("bigint")


def period_text(period: Column | None) -> Column:
    return F.lit("all") if period is None else F.concat(F.lit("p"), F.coalesce(period.cast("string"), F.lit("")))


def fingerprints(df: DataFrame, period: Column, hashed: Callable[[Sequence[Column]], Column] = fast_hash,
                 fields: Sequence[T.StructField] | None = None) -> DataFrame:
    """(period, rows, hash_sum, hash_xor) over the named fields, all by default: one scan, one short row per period."""
    h = hashed([flat(F.col(quoted(f.name)), f.dataType) for f in fields or df.schema.fields])
    return df.select(period.alias("period"), h.alias("h")).groupBy("period").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"))


@dataclass(frozen=True)
class Snapshots:
    """All snapshots of one table under ``path``."""

    spark: SparkSession
    path: str
    hashed: Callable[[Sequence[Column]], Column] = fast_hash

    # --- what is stored ---

    def _manifests(self) -> DataFrame:
        schema = f"{MANIFEST}, {VERSION} int"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def last(self) -> int:
        """The number of the last snapshot, 0 if there is none. An empty table leaves a manifest with a marker row."""
        return self._manifests().agg(F.max(VERSION)).first()[0] or 0

    def report(self, version: int | None = None) -> DataFrame:
        """(period, rows, hash_sum, hash_xor, stored_in, agrees, action): COPIED, KEPT or REMOVED since the one before."""
        wanted = self.last() if version is None else version
        return self._manifests().where((F.col(VERSION) == wanted) & F.col("period").isNotNull()).drop(VERSION, "schema")

    def manifest(self, version: int | None = None) -> DataFrame:
        """The report's periods that are part of the snapshot."""
        return self.report(version).where("action <> 'REMOVED'")

    def schema(self, version: int | None = None) -> T.StructType:
        wanted = self.last() if version is None else version
        row = self._manifests().where(F.col(VERSION) == wanted).select("schema").first()
        if row is None:
            raise ValueError(f"no snapshot {wanted} under {self.path}")
        return T.StructType.fromJson(json.loads(row["schema"]))

    def _stored(self, version: int, lenient: bool = False) -> DataFrame:
        """Rows of a snapshot with their period; only the folders that its manifest names are read."""
        schema = self.schema(version)
        folders: dict[int, list[str]] = {}
        for r in self.manifest(version).select("stored_in", "period").collect():
            folders.setdefault(r["stored_in"], []).append(r["period"])
        full = T.StructType([*schema.fields, T.StructField(PERIOD, T.StringType()), T.StructField(VERSION, T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], full)
        chosen = F.lit(False)
        for stored_in, periods in folders.items():
            chosen = chosen | ((F.col(VERSION) == stored_in) & F.col(PERIOD).isin(periods))
        reader = self.spark.read.schema(full)
        if lenient:
            reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
        return reader.parquet(f"{self.path}/data").where(chosen)

    def read(self, version: int | None = None, periods: Sequence[str] | None = None) -> DataFrame:
        """The table as it was at a snapshot, the last one by default; whole, or some periods as the manifest names them."""
        stored = self._stored(self.last() if version is None else version)
        return (stored if periods is None else stored.where(F.col(PERIOD).isin(list(periods)))).drop(PERIOD, VERSION)

    def damaged(self, version: int | None = None) -> DataFrame:
        """Periods whose stored rows are no longer those of the manifest: (period, rows, stored_rows).

        Reads the whole copy. Files that are lost or cannot be read count as rows that are missing.
        """
        version = self.last() if version is None else version
        wanted = self.manifest(version).select("period", *CONTENT)
        found = fingerprints(self._stored(version, lenient=True), F.col(PERIOD), self.hashed, self.schema(version).fields)
        return _beside(wanted, found).where(~_same()).select(
            "period", "rows", F.coalesce("other_rows", F.lit(0)).alias("stored_rows"))

    # --- taking one ---

    def take(self, source: DataFrame, period: Column | None = None, verify: bool = False) -> DataFrame:
        """Take a snapshot and return its report. ``verify`` reads the last copy as well and replaces what is damaged."""
        if {PERIOD, VERSION} & set(source.columns):
            raise ValueError(f"{PERIOD} and {VERSION} are names of the snapshot's own")
        last, shape = self.last(), source.schema.json()
        now = durable(fingerprints(source, period_text(period), self.hashed))
        known = self.manifest(last)
        trusted = known.where("agrees") if last and self.schema(last).json() == shape else known.limit(0)
        if verify and last:
            trusted = trusted.join(self.damaged(last), "period", "left_anti")
        plan = durable(now.join(trusted.select("period", *CONTENT, "stored_in"), ["period", *CONTENT], "left"))
        wanted = [r["period"] for r in plan.where("stored_in IS NULL").select("period").collect()]
        version, fields = last + 1, source.schema.fields
        folder = f"{self.path}/data/{VERSION}={version}"
        copied = now.limit(0)
        if wanted:
            rows = source.withColumn(PERIOD, period_text(period)).where(F.col(PERIOD).isin(wanted))
            ((rows.hint("rebalance", PERIOD) if len(wanted) > FEW else rows)
             .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PERIOD).parquet(folder))
            written = self.spark.read.schema(T.StructType([*fields, T.StructField(PERIOD, T.StringType())])).parquet(folder)
            copied = fingerprints(written, F.col(PERIOD), self.hashed, fields)
        kept = plan.where("stored_in IS NOT NULL").select(
            "period", *CONTENT, "stored_in", F.lit(True).alias("agrees"), F.lit("KEPT").alias("action"))
        fresh = _beside(plan.where("stored_in IS NULL").drop("stored_in"), copied).select(
            "period", *CONTENT, F.lit(version).alias("stored_in"), _same().alias("agrees"), F.lit("COPIED").alias("action"))
        gone = known.join(now, "period", "left_anti").select(
            "period", *CONTENT, "stored_in", "agrees", F.lit("REMOVED").alias("action"))
        marker = self.spark.range(1).select(*[F.lit(None).cast(t).alias(n) for n, t in
                                              (f.split(" ") for f in MANIFEST.split(", ")[:-1])])
        (kept.unionByName(fresh).unionByName(gone).unionByName(marker).withColumn("schema", F.lit(shape)).coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/manifest/{VERSION}={version}"))
        return self.report(version)


def _beside(wanted: DataFrame, found: DataFrame) -> DataFrame:
    return wanted.join(found.select("period", *[F.col(c).alias(f"other_{c}") for c in CONTENT]), "period", "left")


def _same() -> Column:
    same = F.lit(True)
    for c in CONTENT:
        same = same & F.col(c).eqNullSafe(F.col(f"other_{c}"))
    return same


def snapshot_by_content(spark: SparkSession, warehouse: Warehouse, path: str, periods: Mapping[str, Column] | None = None,
                        verify: bool = False) -> Warehouse:
    """Every table's snapshot under ``path/<name>``, the fact by a period; the warehouse that reads the copies."""
    copies = {name: Snapshots(spark, f"{path}/{name}") for name in warehouse}
    for name, copy in copies.items():
        copy.take(warehouse[name], (periods or {}).get(name), verify)
    return Warehouse({name: copy.read() for name, copy in copies.items()})
