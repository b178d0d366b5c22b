"""Profiles. Every single-table profile is one aggregate; tables are read with only the columns it needs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import predicates as P
from plumbline.operators.validate import quoted


def total() -> Column:
    return F.count(F.lit(1)).alias("total_rows")


def peek(df: DataFrame, *keys: str, n: int = 10) -> DataFrame:
    """All columns of the first rows in key order; without keys, of any rows, which reads no more than it needs."""
    return df.orderBy(*keys).limit(n) if keys else df.limit(n)


def distinct_count(df: DataFrame, names: Mapping[str, Iterable[str]], extra: Iterable[Column] = ()) -> DataFrame:
    """Row count, distinct counts and further aggregates in one row.

    One scan: Spark copies the key columns once per distinct count and combines equal keys before the shuffle.
    """
    counts = [F.count_distinct(*[F.col(quoted(c)) for c in columns]).alias(name) for name, columns in names.items()]
    return df.agg(total(), *extra, *counts)


def scd2_shape(customers: DataFrame) -> DataFrame:
    """Rows, distinct keys, distinct (id, start) pairs, current and historical rows."""
    return distinct_count(
        customers,
        {"distinct_customer_keys": ["customer_key"], "distinct_customer_ids": ["customer_id"],
         "distinct_scd2_keys": ["customer_id", "effective_date"]},
        [F.count_if("is_current").alias("current_rows"), F.count_if(~F.col("is_current")).alias("historical_rows")])


def uniqueness(df: DataFrame, key: str, business_key: str) -> DataFrame:
    return distinct_count(df, {f"distinct_{key}s": [key], f"distinct_{business_key}s": [business_key]})


def composite_distinct(sales: DataFrame) -> DataFrame:
    return distinct_count(sales, {"distinct_sales_keys": ["sales_key"],
                                  "distinct_order_lines": ["order_id", "order_line_num"]})


def null_aggregates(columns: Iterable[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One wide row with the NULLs of every column."""
    return df.agg(total(), *null_aggregates(columns or df.columns))


def null_rates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, null_count, null_pct): counted wide in one pass, then turned into rows."""
    columns = list(columns)
    wide = df.agg(total(), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (wide.unpivot("total_rows", columns, "column_name", "null_count")
            .withColumn("null_pct", P.percent(F.col("null_count"), F.col("total_rows"))).drop("total_rows"))


def distribution(df: DataFrame, column: str | Column, name: str | None = None, pct: bool = False) -> DataFrame:
    """Rows per value. The share divides by a scalar, so no window gathers all groups in one task."""
    groups = df.groupBy(F.col(column).alias(name or column) if isinstance(column, str) else column.alias(name))
    counts = groups.agg(F.count(F.lit(1)).alias("row_count"))
    if not pct:
        return counts
    whole = counts.agg(F.sum("row_count").alias("n")).scalar()
    return counts.withColumn("pct", P.percent(F.col("row_count"), whole))


def by_size(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("row_count"))


def email_aggregates() -> list[Column]:
    email = F.col("email")
    valid = email.rlike(P.anchored(P.EMAIL))
    return [F.count_if(email == "").alias("empty_email"), F.count_if(valid).alias("valid_email_format"),
            F.count_if((email != "") & ~valid).alias("invalid_email_format")]


def email_classes(customers: DataFrame) -> DataFrame:
    return customers.agg(total(), *null_aggregates(["email"]), *email_aggregates())


def date_aggregates(as_of) -> list[Column]:
    start, end = F.col("effective_date"), F.col("expiry_date")
    return [
        F.min(start).alias("earliest_effective"), F.max(start).alias("latest_effective"),
        F.min(end).alias("earliest_expiry"), F.max(end).alias("latest_expiry"),
        F.count_if(start > P.as_date(as_of)).alias("future_effective_count"),
        F.count_if(end < start).alias("expiry_before_effective")]


def date_sanity(customers: DataFrame, as_of) -> DataFrame:
    return customers.agg(*date_aggregates(as_of))


def price_aggregates() -> list[Column]:
    price, cost = F.col("list_price"), F.col("cost_price")
    return [
        F.count_if(price <= 0).alias("list_price_zero_or_negative"),
        F.count_if(cost <= 0).alias("cost_price_zero_or_negative"), F.count_if(cost > price).alias("cost_exceeds_list"),
        F.min(price).alias("min_list_price"), F.max(price).alias("max_list_price"),
        F.min(cost).alias("min_cost_price"), F.max(cost).alias("max_cost_price"),
        F.round(F.avg(price), 2).cast("decimal(14,2)").alias("avg_list_price"),
        F.round(F.avg(cost), 2).cast("decimal(14,2)").alias("avg_cost_price")]


def price_validity(products: DataFrame) -> DataFrame:
    return products.agg(total(), *price_aggregates())


def opening_aggregates(as_of) -> list[Column]:
    opened, today = F.col("opening_date"), P.as_date(as_of)
    return [F.min(opened).alias("earliest_opening"), F.max(opened).alias("latest_opening"),
            F.count_if(opened > today).alias("future_opening_count"), F.max(today).alias("today")]


def opening_dates(stores: DataFrame, as_of) -> DataFrame:
    return stores.agg(*opening_aggregates(as_of))


def calendar_coverage(days: DataFrame) -> DataFrame:
    first, last = F.min("full_date"), F.max("full_date")
    return distinct_count(days, {"distinct_date_keys": ["date_key"], "distinct_dates": ["full_date"]},
                          [first.alias("earliest_date"), last.alias("latest_date"),
                           F.datediff(last, first).alias("day_span")])


def calendar_domains(days: DataFrame) -> DataFrame:
    return distinct_count(days, {"distinct_years": ["year_number"]}, [
        F.count_if(~F.col("month_number").between(1, 12)).alias("invalid_month"),
        F.count_if(~F.col("quarter_number").between(1, 4)).alias("invalid_quarter"),
        F.count_if(~F.col("day_of_week").between(1, 7)).alias("invalid_day_of_week"),
        F.min("year_number").alias("min_year"), F.max("year_number").alias("max_year")]).drop("total_rows")


def date_key_format(days: DataFrame, low: int = 19000101, high: int = 21001231) -> DataFrame:
    key = F.col("date_key")
    return days.agg(F.min(key).alias("min_date_key"), F.max(key).alias("max_date_key"),
                    F.count_if(~key.between(low, high)).alias("date_key_out_of_range"))


def duplicate_sample(df: DataFrame, keys: list[str], limit: int = 20) -> DataFrame:
    """Some duplicate groups, in key order so that the sample is stable."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count")).where("dup_count > 1")
            .orderBy(*keys).limit(limit))


def measure_aggregates() -> list[Column]:
    bad = {"qty_zero_or_neg": "quantity <= 0", "qty_above_10000": "quantity > 10000",
           "price_zero_or_neg": "unit_price <= 0", "cost_negative": "unit_cost < 0",
           "discount_negative": "discount_amount < 0", "revenue_negative": "net_revenue < 0"}
    ranges = {"qty": "quantity", "price": "unit_price", "revenue": "net_revenue"}
    return ([F.count_if(F.expr(rule)).alias(name) for name, rule in bad.items()]
            + [f(c).alias(f"{label}_{n}") for n, c in ranges.items() for label, f in (("min", F.min), ("max", F.max))])


def measure_validity(sales: DataFrame) -> DataFrame:
    return sales.agg(total(), *measure_aggregates())


def arithmetic_aggregates() -> list[Column]:
    return [F.count_if(P.revenue_gap() > F.lit(P.CENT)).alias("revenue_inconsistent"),
            F.count_if(P.profit_gap() > F.lit(P.CENT)).alias("gross_profit_inconsistent")]


def arithmetic(sales: DataFrame) -> DataFrame:
    return sales.agg(total(), *arithmetic_aggregates())


def whole_aggregates(df: DataFrame, table: str, as_of=None) -> list[Column]:
    own = {"dim_customer": lambda: email_aggregates() + date_aggregates(as_of), "dim_product": price_aggregates,
           "dim_store": lambda: opening_aggregates(as_of),
           "fact_sales": lambda: measure_aggregates() + arithmetic_aggregates()}
    return [total(), *null_aggregates(df.columns), *own.get(table, list)()]


def whole_profile(df: DataFrame, table: str, as_of=None) -> DataFrame:
    """Every single-row profile of a table at once: one scan instead of one per profile."""
    return df.agg(*whole_aggregates(df, table, as_of))


def probe(df: DataFrame, name: str, condition: str) -> DataFrame:
    """One number: rows that meet a condition. The filter reaches the scan."""
    return df.where(condition).agg(F.count(F.lit(1)).alias(name))


def missing_days(days: DataFrame, column: str = "full_date") -> DataFrame:
    """Days between the first and the last one that the calendar lacks."""
    span = days.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    wanted = span.select(F.explode(F.sequence("first", "last")).alias("missing_date"))
    return wanted.join(days.select(F.col(column).alias("missing_date")).distinct(), "missing_date", "left_anti")
