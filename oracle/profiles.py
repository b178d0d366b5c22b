"""Oracles of the P queries."""

from __future__ import annotations

from oracle.star import AS_OF, pct, with_star
from oracle.tables import AFTER, ORPHANS, columns

EMAIL = "'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$'"
BROKEN = "abs(net_revenue - (quantity * unit_price - discount_amount)) > 0.01"


def money(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def peek(table: str, keys: str, replaced: tuple[str, ...] = ()) -> str:
    replace = f" REPLACE ({money(*replaced)})" if replaced else ""
    return with_star(f"SELECT *{replace} FROM {table} ORDER BY {keys} LIMIT 10")


def nulls(table: str) -> str:
    counts = ", ".join(f"count(*) - count({c}) AS null_{c}" for c in columns(table))
    return with_star(f"SELECT count(*) AS total_rows, {counts} FROM {table}")


def sizes(table: str, expr: str, name: str) -> str:
    return with_star(f"SELECT {expr} AS {name}, count(*) AS row_count FROM {table} GROUP BY {expr}")


def unique(table: str, key: str, business: str) -> str:
    return with_star(f"SELECT count(*) AS total_rows, count(DISTINCT {key}) AS distinct_{key}s, "
                     f"count(DISTINCT {business}) AS distinct_{business}s FROM {table}")


def hits(name: str, table: str, rule: str) -> str:
    return f"SELECT '{name}' AS probe, count(*) AS hits FROM {table} WHERE {rule}"


RULES = {"R-009": "date", "R-008": "customer", "R-010": "product", "R-011": "store"}
RULE = "CASE check_name " + " ".join(f"WHEN 'fact_sales -> dim_{t}' THEN '{r}'" for r, t in RULES.items()) + " END"
ORPHAN_REPORT = with_star(f"SELECT check_name, {RULE} AS rule_id, orphan_count, "
                          f"CASE WHEN orphan_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({ORPHANS})")
SALES_MONEY = ("unit_price", "unit_cost", "discount_amount", "net_revenue", "gross_profit", "tax_amount")

def sketch(span: str, first: int, last: int, name: str, key: str) -> str:
    """The estimate from all rows of a span at once: 4,096 registers of a 60-bit hash."""
    alpha = repr(0.7213 / (1 + 1.079 / 4096) * 4096 * 4096)
    return f"""
SELECT '{span}' AS span, '{name}' AS key_set, n AS rows, e AS distinct_estimate, round(e * 100e0 / n, 2) AS uniqueness_pct
FROM (SELECT n, least(CAST(round(CASE WHEN raw <= 10240 AND filled < 4096 THEN 4096e0 * ln(4096e0 / (4096 - filled)) ELSE raw END)
    AS BIGINT), n) AS e
  FROM (SELECT CAST(sum(n) AS BIGINT) AS n, count(*) AS filled, {alpha}e0 / ((4096 - count(*)) + sum(pow(2e0, -r))) AS raw
    FROM (SELECT h & 4095 AS register, count(*) AS n, max(CASE WHEN h >> 12 = 0 THEN 49 ELSE 49 - length(bin(h >> 12)) END) AS r
      FROM (SELECT CAST('0x' || substr(md5({key}), 1, 15) AS BIGINT) AS h FROM dated_sales
        WHERE year(load_date) BETWEEN {first} AND {last}) GROUP BY 1)))"""


ORACLE = {
    "P3_distinct_sketches": with_star("\nUNION ALL ".join(
        sketch(*span, name, key) for span in (("all", 0, 9999), ("1995", 1995, 1995), ("1996 on", 1996, 9999))
        for name, key in (("order_id", "order_id"), ("customer_key", "CAST(customer_key AS VARCHAR)"),
                          ("order_line", "order_id || '|' || order_line_num")))),
    "P1_peek_dim_customer": peek("dim_customer", "customer_key"),
    "P1_peek_dim_product": peek("dim_product", "product_key", ("list_price", "cost_price")),
    "P1_peek_dim_store": peek("dim_store", "store_key"),
    "P1_peek_dim_date": peek("dim_date", "date_key"),
    "P1_peek_fact_sales": with_star(
        f"SELECT * REPLACE ({money(*SALES_MONEY)}) FROM (SELECT * FROM fact_sales ORDER BY sales_key, product_key, "
        "store_key, quantity, unit_price, discount_amount, tax_amount LIMIT 10)"),
    "P2_scd2_shape": with_star("""
SELECT count(*) AS total_rows, count(DISTINCT customer_key) AS distinct_customer_keys,
  count(DISTINCT customer_id) AS distinct_customer_ids,
  count(DISTINCT (customer_id, effective_date)) FILTER (WHERE customer_id IS NOT NULL AND effective_date IS NOT NULL)
    AS distinct_scd2_keys,
  count(*) FILTER (WHERE is_current) AS current_rows, count(*) FILTER (WHERE NOT is_current) AS historical_rows
FROM dim_customer"""),
    "P3_distinct_composite_key": with_star("""
SELECT count(*) AS total_rows, count(DISTINCT sales_key) AS distinct_sales_keys,
  count(DISTINCT (order_id, order_line_num)) FILTER (WHERE order_id IS NOT NULL AND order_line_num IS NOT NULL)
    AS distinct_order_lines FROM fact_sales"""),
    "P4_null_counts_dim_customer": nulls("dim_customer"),
    "P4_null_counts_dim_product": nulls("dim_product"),
    "P4_null_counts_dim_store": nulls("dim_store"),
    "P4_null_counts_fact_sales": nulls("fact_sales"),
    "P5_null_rates": with_star(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        f"{pct(f'(count(*) - count({c}))', 'count(*)')} AS null_pct FROM dim_customer"
        for c in ("email", "customer_segment"))),
    "P6_heavy_values": with_star(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS row_count, {pct('count(*)', 'max(total)')} AS pct "
        f"FROM (SELECT {c}, CAST(count(*) OVER () AS BIGINT) AS total FROM fact_sales) GROUP BY {c} "
        "HAVING count(*) >= 0.0045e0 * max(total)"
        for c in ("customer_key", "order_id", "date_key", "quantity", "discount_amount", "unit_price"))),
    "P6_distribution_pct": with_star(f"""
SELECT customer_segment, n AS row_count, {pct('n', 'total')} AS pct
FROM (SELECT customer_segment, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total
      FROM dim_customer GROUP BY customer_segment)"""),
    "P7_distribution_category": sizes("dim_product", "category", "category"),
    "P7_distribution_store_type": sizes("dim_store", "store_type", "store_type"),
    "P7_distribution_region": sizes("dim_store", "region", "region"),
    "P8_email_classes": with_star(f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE email IS NULL) AS null_email,
  count(*) FILTER (WHERE email = '') AS empty_email,
  count(*) FILTER (WHERE regexp_matches(email, {EMAIL})) AS valid_email_format,
  count(*) FILTER (WHERE email <> '' AND NOT regexp_matches(email, {EMAIL})) AS invalid_email_format
FROM dim_customer"""),
    "P9_date_sanity": with_star(f"""
SELECT min(effective_date) AS earliest_effective, max(effective_date) AS latest_effective,
  min(expiry_date) AS earliest_expiry, max(expiry_date) AS latest_expiry,
  count(*) FILTER (WHERE effective_date > DATE '{AS_OF}') AS future_effective_count,
  count(*) FILTER (WHERE expiry_date < effective_date) AS expiry_before_effective FROM dim_customer"""),
    "P10_uniqueness_dim_product": unique("dim_product", "product_key", "product_id"),
    "P10_uniqueness_dim_store": unique("dim_store", "store_key", "store_id"),
    "P11_price_validity": with_star("""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE list_price <= 0) AS list_price_zero_or_negative,
  count(*) FILTER (WHERE cost_price <= 0) AS cost_price_zero_or_negative,
  count(*) FILTER (WHERE cost_price > list_price) AS cost_exceeds_list,
  CAST(min(list_price) AS DOUBLE) AS min_list_price, CAST(max(list_price) AS DOUBLE) AS max_list_price,
  CAST(min(cost_price) AS DOUBLE) AS min_cost_price, CAST(max(cost_price) AS DOUBLE) AS max_cost_price,
  CAST((sum(CAST(list_price * 100 AS BIGINT)) * 2 + count(list_price)) // (count(list_price) * 2) AS DOUBLE) / 100
    AS avg_list_price,
  CAST((sum(CAST(cost_price * 100 AS BIGINT)) * 2 + count(cost_price)) // (count(cost_price) * 2) AS DOUBLE) / 100
    AS avg_cost_price FROM dim_product"""),
    "P12_opening_dates": with_star(f"""
SELECT min(opening_date) AS earliest_opening, max(opening_date) AS latest_opening,
  count(*) FILTER (WHERE opening_date > DATE '{AS_OF}') AS future_opening_count, DATE '{AS_OF}' AS today
FROM dim_store"""),
    "P13_length_histogram": sizes("dim_store", "CAST(length(city) AS INTEGER)", "city_length"),
    "P13_state_length": sizes("dim_store", "CAST(length(state) AS INTEGER)", "state_length"),
    "P14_calendar_coverage": with_star("""
SELECT count(*) AS total_rows, count(DISTINCT date_key) AS distinct_date_keys,
  count(DISTINCT full_date) AS distinct_dates, min(full_date) AS earliest_date, max(full_date) AS latest_date,
  CAST(max(full_date) - min(full_date) AS INTEGER) AS day_span FROM dim_date"""),
    "P15_calendar_domains": with_star("""
SELECT count(*) FILTER (WHERE month_number NOT BETWEEN 1 AND 12) AS invalid_month,
  count(*) FILTER (WHERE quarter_number NOT BETWEEN 1 AND 4) AS invalid_quarter,
  count(*) FILTER (WHERE day_of_week NOT BETWEEN 1 AND 7) AS invalid_day_of_week,
  count(DISTINCT year_number) AS distinct_years, min(year_number) AS min_year, max(year_number) AS max_year
FROM dim_date"""),
    "P16_date_key_format": with_star("""
SELECT min(date_key) AS min_date_key, max(date_key) AS max_date_key,
  count(*) FILTER (WHERE date_key < 19000101 OR date_key > 21001231) AS date_key_out_of_range FROM dim_date"""),
    "P17_duplicate_sample": with_star("""
SELECT order_id, order_line_num, count(*) AS dup_count FROM fact_sales GROUP BY order_id, order_line_num
HAVING count(*) > 1 ORDER BY order_id, order_line_num LIMIT 20"""),
    "P18_measure_validity": with_star("""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE quantity <= 0) AS qty_zero_or_neg,
  count(*) FILTER (WHERE quantity > 10000) AS qty_above_10000,
  count(*) FILTER (WHERE unit_price <= 0) AS price_zero_or_neg, count(*) FILTER (WHERE unit_cost < 0) AS cost_negative,
  count(*) FILTER (WHERE discount_amount < 0) AS discount_negative,
  count(*) FILTER (WHERE net_revenue < 0) AS revenue_negative, min(quantity) AS min_qty, max(quantity) AS max_qty,
  CAST(min(unit_price) AS DOUBLE) AS min_price, CAST(max(unit_price) AS DOUBLE) AS max_price,
  CAST(min(net_revenue) AS DOUBLE) AS min_revenue, CAST(max(net_revenue) AS DOUBLE) AS max_revenue FROM fact_sales"""),
    "P19_arithmetic": with_star(f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE {BROKEN}) AS revenue_inconsistent,
  count(*) FILTER (WHERE abs(gross_profit - (net_revenue - quantity * unit_cost)) > 0.01) AS gross_profit_inconsistent
FROM fact_sales"""),
    "P20_orphan_report": ORPHAN_REPORT,
    "P20_orphan_report_bitmaps": ORPHAN_REPORT,
    "P20_orphan_report_large_dimensions": ORPHAN_REPORT,
    "P21_scorecard": with_star(f"""
SELECT fact_rows, orphan_date, orphan_customer, orphan_product, orphan_store, revenue_broken,
  {pct('(fact_rows - orphan_date - orphan_customer - orphan_product - orphan_store - revenue_broken)', 'fact_rows')}
    AS clean_pct,
  {pct('clean', 'fact_rows')} AS distinct_clean_pct
FROM (SELECT count(*) AS fact_rows, count(*) FILTER (WHERE d.k IS NULL) AS orphan_date,
    count(*) FILTER (WHERE c.k IS NULL) AS orphan_customer, count(*) FILTER (WHERE p.k IS NULL) AS orphan_product,
    count(*) FILTER (WHERE s.k IS NULL) AS orphan_store, count(*) FILTER (WHERE {BROKEN}) AS revenue_broken,
    count(*) FILTER (WHERE d.k IS NOT NULL AND c.k IS NOT NULL AND p.k IS NOT NULL AND s.k IS NOT NULL
      AND NOT coalesce({BROKEN}, false)) AS clean
  FROM fact_sales f LEFT JOIN (SELECT DISTINCT date_key AS k FROM dim_date) d ON f.date_key = d.k
    LEFT JOIN (SELECT DISTINCT customer_key AS k FROM dim_customer) c ON f.customer_key = c.k
    LEFT JOIN (SELECT DISTINCT product_key AS k FROM dim_product) p ON f.product_key = p.k
    LEFT JOIN (SELECT DISTINCT store_key AS k FROM dim_store) s ON f.store_key = s.k)"""),
    "P22_probes": with_star(" UNION ALL ".join([
        hits("bad_price_count", "dim_product", "list_price <= 0"),
        hits("cost_exceeds_price", "dim_product", "cost_price >= list_price"),
        hits("null_email_count", "dim_customer", "email IS NULL"),
        hits("negative_qty_count", "fact_sales", "quantity < 1"),
        hits("orphan_count", "fact_sales", "customer_key NOT IN (SELECT customer_key FROM dim_customer)")])),
    "P23_missing_days": with_star("""
SELECT CAST(d AS DATE) AS missing_date
FROM (SELECT unnest(generate_series((SELECT min(full_date) FROM dim_date), (SELECT max(full_date) FROM dim_date),
  INTERVAL 1 DAY)) AS d) WHERE CAST(d AS DATE) NOT IN (SELECT full_date FROM dim_date)"""),
}


def together(table: str, *names: str) -> str:
    return with_star(side_by_side(table, *names))


def side_by_side(table: str, *names: str) -> str:
    """Single-row profiles, each still a statement of its own."""
    bodies = [ORACLE[n][ORACLE[n].index("SELECT", ORACLE[n].rindex("\nSELECT")):] for n in names]
    counts = ", ".join(f"count(*) - count({c}) AS null_{c}" for c in columns(table))
    listed = [f"SELECT count(*) AS total_rows, {counts} FROM {table}"] + bodies
    known = "SELECT * EXCLUDE ({})".format
    parts = [f"({listed[0]}) p0"]
    for i, body in enumerate(listed[1:], 1):
        doubled = [c for c in ("total_rows", "null_email") if f"AS {c}" in body]
        parts.append(f"({known(', '.join(doubled)) if doubled else 'SELECT *'} FROM ({body})) p{i}")
    return "SELECT * FROM " + ", ".join(parts)


ORACLE.update({
    "P4_whole_profile_dim_customer": together("dim_customer", "P8_email_classes", "P9_date_sanity"),
    "P4_whole_profile_dim_product": together("dim_product", "P11_price_validity"),
    "P4_whole_profile_dim_store": together("dim_store", "P12_opening_dates"),
    "P4_whole_profile_fact_sales": together("fact_sales", "P18_measure_validity", "P19_arithmetic"),
})

# The same statements over the fact after a load, read whole.
ORACLE["P4_profile_from_states"] = with_star(
    side_by_side("fact_sales", "P18_measure_validity", "P19_arithmetic").replace("fact_sales", "after_load")
    + ", (SELECT 2 AS years_read, 4 AS years_kept, 1 AS years_removed)", {"after_load": AFTER})
ORACLE["P13_histograms_from_states"] = with_star(" UNION ALL ".join(
    f"SELECT '{name}' AS column_name, CAST({expr} AS VARCHAR) AS value, count(*) AS row_count FROM after_load GROUP BY 2"
    for name, expr in (("order_line_num", "order_line_num"), ("quantity", "quantity"), ("key_length", "length(order_id)"))),
    {"after_load": AFTER})
