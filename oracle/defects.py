"""Oracles of the D and I queries."""

from __future__ import annotations

from itertools import combinations

from oracle.data import FULL
from oracle.star import AS_OF, pct, with_star
from oracle.suites import results


def whole(table: str, replace: str, money: tuple[str, ...] = ()) -> str:
    inner = f"SELECT * REPLACE ({replace}) FROM {table}"
    if money:
        inner = f"SELECT * REPLACE ({', '.join(f'CAST({m} AS DOUBLE) AS {m}' for m in money)}) FROM ({inner})"
    return with_star(inner)


PRICES = ("list_price", "cost_price")
HITS = {
    "D1": ("Completeness", "SELECT count(*) FROM x_dim_customer WHERE email IS NULL", 300),
    "D2": ("Uniqueness", "SELECT count(*) FROM (SELECT customer_id FROM x_dim_customer WHERE is_current "
                         "GROUP BY customer_id HAVING count(*) > 1)", 10),
    "D3": ("Validity", "SELECT count(*) FROM x_dim_customer WHERE email = 'n/a'", 200),
    "D4": ("Validity", "SELECT count(*) FROM x_dim_customer WHERE customer_segment = 'Platnium'", 50),
    "D5": ("Validity", "SELECT count(*) FROM x_dim_product WHERE list_price = 0", 15),
    "D6": ("Accuracy", "SELECT count(*) FROM x_dim_product WHERE cost_price > list_price", 10),
    "D7": ("Consistency", "SELECT count(*) FROM x_fact_sales f LEFT JOIN x_dim_customer c "
                          "ON f.customer_key = c.customer_key WHERE c.customer_key IS NULL", 50),
    "D8": ("Validity", "SELECT count(*) FROM x_fact_sales WHERE quantity = -1", 100),
}
CHECKED = {"results": results(FULL.values(), "x_")}
ISSUE = "'D' || right(issue_id, 1)"
DETECTION = (f"SELECT {ISSUE} AS defect, issue_id, table_name, count(*) AS checks, "
             "count(*) FILTER (WHERE status = 'FAIL') AS failed_checks, "
             "count(*) FILTER (WHERE status = 'FAIL') > 0 AS caught "
             "FROM results WHERE issue_id IS NOT NULL GROUP BY issue_id, table_name")


def f64(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


REVENUE, PROFIT = "(quantity * unit_price - discount_amount)", "(net_revenue - quantity * unit_cost)"
REV_BAD, PROFIT_BAD = f"abs(net_revenue - {REVENUE}) > 0.01", f"abs(gross_profit - {PROFIT}) > 0.01"

def g_squared(n: str, f: str, whole: str, failures: str) -> str:
    """Twice the log likelihood ratio of a two by two table: in the slice or not, failed or not."""
    cells = [(f, n, failures), (f"({n} - {f})", n, f"({whole} - {failures})"),
             (f"({failures} - {f})", f"({whole} - {n})", failures),
             (f"({whole} - {n} - {failures} + {f})", f"({whole} - {n})", f"({whole} - {failures})")]
    return "2 * (" + " + ".join(
        f"CASE WHEN {seen} > 0 THEN {seen} * ln({seen} * CAST({whole} AS DOUBLE) / (CAST({row} AS DOUBLE) * {column})) ELSE 0 END"
        for seen, row, column in cells) + ")"


SLICED = {"year": "date_key // 10000", "line": "order_line_num", "region": "region", "brand": "brand",
          "quantity below 1": "quantity < 1", "loss": "gross_profit < 0"}


def failure_slices(broken: str) -> str:
    """Every combination of up to three dimensions is grouped and compared with those of one condition less."""
    names = [f"d{i}" for i in range(len(SLICED))]
    sets = ", ".join(f"({', '.join(s)})" for k in range(4) for s in combinations(names, k))
    values = ", ".join(f"coalesce(CAST({e} AS VARCHAR), chr(9216)) AS {n}" for n, e in zip(names, SLICED.values()))
    depth = " + ".join(f"CAST({n} IS NOT NULL AS INTEGER)" for n in names)
    within = " AND ".join(f"(p.{n} IS NULL OR p.{n} IS NOT DISTINCT FROM c.{n})" for n in names)
    listed = ", ".join(f"'{label}=' || {n}" for label, n in zip(SLICED, names))
    return with_star(f"""
SELECT conditions, depth, n AS rows, f AS failures, round(f * 100e0 / n, 2) AS failure_pct,
  round(f * 100e0 / all_f, 2) AS share_pct, round({g_squared('n', 'f', 'all_n', 'all_f')}, 4) AS g2, round(gain, 4) AS gain
FROM (SELECT c.conditions, c.depth, c.n, c.f, t.n AS all_n, t.f AS all_f,
    min(CASE WHEN c.f * p.n > p.f * c.n THEN {g_squared('c.n', 'c.f', 'p.n', 'p.f')} ELSE 0 END) AS gain
  FROM cube c, cube t, cube p
  WHERE t.depth = 0 AND c.depth > 0 AND c.f >= 5 AND c.f >= 0.01e0 * t.f AND p.depth = c.depth - 1 AND {within}
  GROUP BY ALL) WHERE gain >= 10.83 AND f * all_n > n * all_f""", {
        "valued": f"SELECT coalesce({broken}, false) AS failed, {values} FROM x_fact_sales s "
                  "LEFT JOIN x_dim_store USING (store_key) LEFT JOIN x_dim_product USING (product_key)",
        "cube": f"SELECT *, concat_ws(',', {listed}) AS conditions, {depth} AS depth FROM (SELECT {', '.join(names)}, "
                f"count(*) AS n, count(*) FILTER (WHERE failed) AS f FROM valued GROUP BY GROUPING SETS ({sets}))"})


ORACLE = {
    "D1_null_email": whole("dim_customer",
                           "CASE WHEN customer_key BETWEEN 1 AND 300 THEN NULL ELSE email END AS email"),
    "D2_duplicate_current": with_star(f"""
SELECT * FROM dim_customer UNION ALL
SELECT customer_key + 100000, customer_id, customer_name || ' [DUP]', email, city, state, zip_code, customer_segment,
  DATE '{AS_OF}', DATE '9999-12-31', true FROM dim_customer WHERE customer_key BETWEEN 1001 AND 1010"""),
    "D3_sentinel_email": whole("dim_customer",
                               "CASE WHEN customer_key BETWEEN 2001 AND 2200 THEN 'n/a' ELSE email END AS email"),
    "D4_segment_typo": whole("dim_customer", "CASE WHEN customer_key BETWEEN 3001 AND 3050 THEN 'Platnium' "
                                             "ELSE customer_segment END AS customer_segment"),
    "D5_zero_price": whole("dim_product", "CASE WHEN product_key BETWEEN 101 AND 115 THEN 0 ELSE list_price END "
                                          "AS list_price", PRICES),
    "D6_cost_over_price": whole("dim_product", "CASE WHEN product_key BETWEEN 201 AND 210 THEN list_price + 50 "
                                               "ELSE cost_price END AS cost_price", PRICES),
    "D7_orphan_rows": with_star("""
SELECT false AS generated, count(*) AS rows, count(DISTINCT sales_key) AS keys, max(order_id) AS max_order_id,
  CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue,
  CAST(sum(gross_profit) AS DOUBLE) AS gross_profit FROM fact_sales
UNION ALL SELECT true, count(*), count(DISTINCT sales_key), max(order_id), CAST(sum(quantity) AS BIGINT),
  CAST(sum(net_revenue) AS DOUBLE), CAST(sum(gross_profit) AS DOUBLE) FROM x_fact_sales WHERE customer_key = 999999"""),
    "D8_negative_quantity": with_star("""
SELECT quantity, count(*) AS rows, min(sales_key) AS min_sales_key, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue
FROM x_fact_sales WHERE sales_key < 900000000000 GROUP BY quantity"""),
    **{f"D9_verify_{d}": with_star(f"SELECT '{d}' AS defect, '{dim}' AS dimension, ({q}) AS affected_rows")
       for d, (dim, q, _) in HITS.items()},
    "D10_affected_rows": with_star(" UNION ALL ".join(
        f"SELECT '{d}' AS defect, '{dim}' AS dimension, ({q}) AS rows, CAST({n} AS BIGINT) AS expected"
        for d, (dim, q, n) in HITS.items())),
    "D11_detection": with_star(DETECTION, CHECKED),
    "D11_detection_rate": with_star(
        f"SELECT count(*) AS defects, count(*) FILTER (WHERE caught) AS caught, "
        f"{pct('count(*) FILTER (WHERE caught)', 'count(*)')} AS detection_rate FROM "
        f"(SELECT defect, bool_or(caught) AS caught FROM ({DETECTION}) GROUP BY defect)", CHECKED),
    "D12_predicted_outcome": with_star("""
SELECT table_name, check_no, predicted, status,
  CASE WHEN status = 'FAIL' AND predicted IS NULL THEN 'UNPREDICTED_FAIL'
       WHEN status = 'PASS' AND predicted = 'FAIL' THEN 'MISSED' ELSE 'MATCH' END AS outcome FROM results""", CHECKED),
    "I1_top_duplicates": with_star("""
SELECT order_id, order_line_num, count(*) AS dup_count FROM x_fact_sales GROUP BY order_id, order_line_num
HAVING count(*) > 1 ORDER BY dup_count DESC, order_id, order_line_num LIMIT 10"""),
    "I2_top_revenue_breaks": with_star(f"""
SELECT sales_key, quantity, {f64('unit_price', 'discount_amount', 'net_revenue', 'computed_revenue', 'diff')} FROM (
SELECT *, {REVENUE} AS computed_revenue, abs(net_revenue - {REVENUE}) AS diff FROM x_fact_sales WHERE {REV_BAD}
ORDER BY diff DESC, sales_key, unit_price LIMIT 10)"""),
    "I3_top_profit_breaks": with_star(f"""
SELECT sales_key, quantity, {f64('unit_cost', 'net_revenue', 'gross_profit', 'computed_profit', 'diff')} FROM (
SELECT *, {PROFIT} AS computed_profit, abs(gross_profit - {PROFIT}) AS diff FROM x_fact_sales WHERE {PROFIT_BAD}
ORDER BY diff DESC, sales_key, unit_cost LIMIT 10)"""),
    "I4_below_minimum": with_star(" UNION ALL ".join(
        f"SELECT '{c} below min' AS check, count(*) AS violations FROM x_fact_sales WHERE {c} < {low}"
        for c, low in (("tax_amount", 0), ("net_revenue", -10000), ("gross_profit", -10000)))),
    "I5_lowest_tax": with_star(f"""
SELECT sales_key, date_key, customer_key, product_key, quantity, {f64('unit_price', 'net_revenue', 'tax_amount')}
FROM (SELECT * FROM x_fact_sales WHERE tax_amount < 0 ORDER BY tax_amount, sales_key, unit_price LIMIT 10)"""),
    "I6_margin_deficit": with_star(f"""
SELECT product_key, product_id, product_name, {f64('list_price', 'cost_price')},
  CAST(cost_price - list_price AS DOUBLE) AS margin_deficit
FROM x_dim_product WHERE cost_price >= list_price AND list_price > 0"""),
    "I7_unpriced": with_star(f"SELECT product_key, product_id, product_name, {f64('list_price')} FROM x_dim_product "
                             "WHERE list_price <= 0"),
    "I8_failure_slices": failure_slices("abs(net_revenue - (quantity * unit_price - discount_amount)) > 0.01"),
    "I8_root_cause": with_star(f"""
SELECT * FROM (
SELECT 'quantity' AS rule, CASE WHEN quantity = -1 THEN 'injected' ELSE 'pre-existing' END AS cause, count(*) AS rows
  FROM x_fact_sales WHERE quantity < 1 GROUP BY 2
UNION ALL SELECT 'net_revenue identity', CASE WHEN quantity = -1 THEN 'cascade' ELSE 'pre-existing' END, count(*)
  FROM x_fact_sales WHERE {REV_BAD} GROUP BY 2
UNION ALL SELECT 'gross_profit identity', CASE WHEN quantity = -1 THEN 'cascade' ELSE 'pre-existing' END, count(*)
  FROM x_fact_sales WHERE {PROFIT_BAD} GROUP BY 2
UNION ALL SELECT 'tax_amount', 'pre-existing', count(*) FROM x_fact_sales WHERE tax_amount < 0
UNION ALL SELECT 'order line', 'pre-existing', coalesce(CAST(sum(n) AS BIGINT), 0) FROM
  (SELECT count(*) AS n FROM x_fact_sales GROUP BY order_id, order_line_num HAVING count(*) > 1)) WHERE rows > 0"""),
}
