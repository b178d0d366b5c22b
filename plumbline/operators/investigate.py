"""Drill-down into failed checks: the worst groups and rows, and where a failure comes from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import predicates as P


def top_duplicates(df: DataFrame, keys: list[str], limit: int = 10) -> DataFrame:
    """Largest duplicate groups; ties in key order."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count")).where("dup_count > 1")
            .orderBy(F.desc("dup_count"), *keys).limit(limit))


def top_revenue_breaks(sales: DataFrame, limit: int = 10) -> DataFrame:
    broken = sales.select("sales_key", "quantity", "unit_price", "discount_amount", "net_revenue",
                          P.computed_revenue().alias("computed_revenue"), P.revenue_gap().alias("diff"))
    return broken.where(F.col("diff") > F.lit(P.CENT)).orderBy(F.desc("diff"), "sales_key", "unit_price").limit(limit)


def top_profit_breaks(sales: DataFrame, limit: int = 10) -> DataFrame:
    broken = sales.select("sales_key", "quantity", "unit_cost", "net_revenue", "gross_profit",
                          P.computed_profit().alias("computed_profit"), P.profit_gap().alias("diff"))
    return broken.where(F.col("diff") > F.lit(P.CENT)).orderBy(F.desc("diff"), "sales_key", "unit_cost").limit(limit)


# Lower limits of the measures.
MINIMUM = {"tax_amount": 0, "net_revenue": -10_000, "gross_profit": -10_000}


def below_minimum(sales: DataFrame, minimum: dict[str, int] = MINIMUM) -> DataFrame:
    """(check, violations), one row per measure, from one scan."""
    counts = sales.agg(*[F.count_if(F.col(c) < low).alias(f"{c} below min") for c, low in minimum.items()])
    return counts.unpivot([], counts.columns, "check", "violations")


def lowest(sales: DataFrame, measure: str = "tax_amount", limit: int = 10) -> DataFrame:
    """Evidence rows with a negative measure, lowest first."""
    return (sales.where(F.col(measure) < 0)
            .select("sales_key", "date_key", "customer_key", "product_key", "quantity", "unit_price",
                    "net_revenue", measure)
            .orderBy(measure, "sales_key", "unit_price").limit(limit))


def margin_deficit(products: DataFrame) -> DataFrame:
    """Products sold at or below cost, worst first."""
    return (products.where((F.col("cost_price") >= F.col("list_price")) & (F.col("list_price") > 0))
            .select("product_key", "product_id", "product_name", "list_price", "cost_price",
                    (F.col("cost_price") - F.col("list_price")).alias("margin_deficit"))
            .orderBy(F.desc("margin_deficit"), "product_key"))


def unpriced(products: DataFrame) -> DataFrame:
    return products.where(F.col("list_price") <= 0).select("product_key", "product_id", "product_name", "list_price")


def root_cause(sales: DataFrame) -> DataFrame:
    """Failures of the fact by cause: injected, a cascade of it on the same row, or already there.

    Duplicate order lines cannot come from the injected defects and count as pre-existing rows.
    """
    returned = F.col("quantity") == -1
    revenue, profit = P.revenue_gap() > F.lit(P.CENT), P.profit_gap() > F.lit(P.CENT)
    rules = {"quantity": F.col("quantity") < 1, "net_revenue identity": revenue, "gross_profit identity": profit,
             "tax_amount": F.col("tax_amount") < 0}
    cause = {"quantity": ("injected", "pre-existing"), "net_revenue identity": ("cascade", "pre-existing"),
             "gross_profit identity": ("cascade", "pre-existing"), "tax_amount": ("pre-existing", "pre-existing")}
    counts = sales.agg(*[F.count_if(broken & hit).alias(f"{rule}|{cause[rule][side]}|{side}")
                         for rule, broken in rules.items()
                         for side, hit in enumerate((returned, ~returned))])
    duplicates = (sales.groupBy("order_id", "order_line_num").agg(F.count(F.lit(1)).alias("n"))
                  .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows"))
                  .select(F.lit("order line").alias("rule"), F.lit("pre-existing").alias("cause"), "rows"))
    parts = F.split("key", r"\|")
    long = counts.unpivot([], counts.columns, "key", "hits").select(
        parts[0].alias("rule"), parts[1].alias("cause"), "hits")
    return (long.groupBy("rule", "cause").agg(F.sum("hits").alias("rows")).unionByName(duplicates)
            .where("rows > 0"))
