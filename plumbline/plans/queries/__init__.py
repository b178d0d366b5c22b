"""Registered queries, one per operator of the inventory. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

# The day all time-dependent checks are judged on; never the wall clock.
AS_OF = "2026-04-29"


def plain(df: DataFrame) -> DataFrame:
    """Values any client can compare: decimals as doubles, lists as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def all_queries() -> dict[str, Query]:
    from plumbline.plans.queries import (anomalies, checks, contracts, defects, profiles, repairs, scores, tables)

    found: dict[str, Query] = {}
    for module in (tables, checks, profiles, defects, repairs, anomalies, scores, contracts):
        for name, query in module.QUERIES.items():
            found[name] = (lambda q: lambda spark, sf_dir: plain(q(spark, sf_dir)))(query)
    return found
