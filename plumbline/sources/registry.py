"""Where tables come from: a name → DataFrame registry over Parquet, JDBC or catalog tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from plumbline.sources.schemas import WAREHOUSE, schema


class Schemas(Mapping[str, StructType]):
    """Named schemas, or functions that read them when first asked for."""

    def __init__(self, schemas: Mapping[str, StructType | Callable[[], StructType]]):
        self._schemas = dict(schemas.parts() if isinstance(schemas, Schemas) else schemas)

    def __getitem__(self, name: str) -> StructType:
        found = self._schemas[name]
        if not isinstance(found, StructType):
            found = self._schemas[name] = found()
        return found

    def parts(self) -> dict[str, StructType | Callable[[], StructType]]:
        return dict(self._schemas)

    def __iter__(self):
        return iter(self._schemas)

    def __len__(self) -> int:
        return len(self._schemas)


class Warehouse(Mapping[str, DataFrame]):
    """Named tables of one warehouse: DataFrames, or functions that build them when first asked for.

    ``stored`` has the schemas of the files below, where they are known; a table read with its declared schema does not
    show them.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 stored: Mapping[str, StructType | Callable[[], StructType]] | None = None):
        self._tables = dict(tables.parts() if isinstance(tables, Warehouse) else tables)
        self.stored = Schemas(stored or {})

    def __getitem__(self, name: str) -> DataFrame:
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def parts(self) -> dict[str, DataFrame | Callable[[], DataFrame]]:
        return dict(self._tables)

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def replaced(self, **tables: DataFrame | Callable[[], DataFrame]) -> "Warehouse":
        """The same warehouse with some tables swapped; the original stays as it is."""
        return Warehouse({**self._tables, **tables}, {n: s for n, s in self.stored.parts().items() if n not in tables})

    def head(self, name: str, n: int = 5, order_by: str | None = None) -> DataFrame:
        df = self[name]
        return (df.orderBy(order_by) if order_by else df).limit(n)

    def register_views(self) -> None:
        """Make every table reachable from ``spark.sql`` under its plain name."""
        for name, df in self.items():
            df.createOrReplaceTempView(name)

    def snapshot(self, spark: SparkSession, path: str) -> "Warehouse":
        """Copy every table to Parquet and return the warehouse that reads the copy.

        Defects and repairs work on the copy, so the source cannot change under them.
        """
        for name, df in self.items():
            df.write.mode("overwrite").parquet(os.path.join(path, name))
        return Warehouse({name: spark.read.schema(df.schema).parquet(os.path.join(path, name))
                          for name, df in self.items()})


def from_parquet(spark: SparkSession, root: str, names: Iterable[str] = WAREHOUSE) -> Warehouse:
    """Tables stored as ``root/<name>``, read with their declared schemas.

    Their files' schemas are beside them; a table's footers are read when its stored schema is first asked for.
    """
    paths = {n: os.path.join(root, n) for n in names}
    return Warehouse({n: spark.read.schema(schema(n)).parquet(p) for n, p in paths.items()},
                     {n: (lambda path: lambda: stored_schema(spark, path))(p) for n, p in paths.items()})


def stored_schema(spark: SparkSession, path: str) -> StructType:
    """What the file footers say, columns of all files together. Spark reads footers only, in a job of its own."""
    return spark.read.option("mergeSchema", "true").parquet(path).schema


def schema_drift(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Every column that is declared or stored: its two places and types, and OK, MISSING, EXTRA, MOVED or RETYPED.

    Columns are MOVED when the order of those in both differs, so that one missing column does not mark all after it.
    """
    rows = []
    for table, stored in warehouse.stored.items():
        declared = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(schema(table), 1)}
        found = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(stored, 1)}
        order = [n for n in found if n in declared]
        place = {n: i for i, n in enumerate(order)}
        for name in [*declared, *[n for n in found if n not in declared]]:
            there, here = declared.get(name, (None, None)), found.get(name, (None, None))
            if here[0] is None or there[0] is None:
                status = "MISSING" if here[0] is None else "EXTRA"
            elif there[1] != here[1]:
                status = "RETYPED"
            else:
                status = "OK" if [n for n in declared if n in place].index(name) == place[name] else "MOVED"
            rows.append((table, name, there[0], here[0], there[1], here[1], status))
    return spark.createDataFrame(rows, "table_name string, column_name string, declared_position int, "
                                       "stored_position int, declared_type string, stored_type string, status string")


def from_catalog(spark: SparkSession, database: str, names: Iterable[str] = WAREHOUSE) -> Warehouse:
    return Warehouse({n: spark.table(f"{database}.{n}") for n in names})


def from_jdbc(spark: SparkSession, url: str, database: str, names: Iterable[str] = WAREHOUSE,
              split: Mapping[str, tuple[str, int, int, int]] | None = None, **options: str) -> Warehouse:
    """Tables of a relational database.

    ``split`` gives (column, lower, upper, partitions) for tables worth reading in parallel; filters and column
    selection are pushed to the database. Needs the vendor's JDBC driver on the class path.
    """
    tables = {}
    for name in names:
        reader = spark.read.format("jdbc").options(url=url, dbtable=f"{database}.{name}", **options)
        if split and name in split:
            column, low, high, parts = split[name]
            reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
        tables[name] = reader.load()
    return Warehouse(tables)


def save_bucketed(df: DataFrame, table: str, keys: Iterable[str], buckets: int, path: str | None = None) -> DataFrame:
    """Store a large table bucketed by the key its checks group by.

    Uniqueness and duplicate checks on these keys, and joins with a table bucketed alike, then need no shuffle.
    """
    keys = list(keys)
    writer = df.write.mode("overwrite").bucketBy(buckets, *keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)
