"""DuckDB reference SQL for every registered query.

The driver registers the raw test tables as views (``lineitem``, ``orders``,
...).  Each statement below first rebuilds the canonical tables with the same
mapping as ``basketry.sources.tables`` (CTEs), then states the query plainly in
SQL.  But for the sentence templates (fixed values, taken from the plans) the SQL is independent of the
Spark code: it is the brute-force definition the Spark plans are checked against.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# canonical tables
# ---------------------------------------------------------------------------

GROSS = "CAST(l_extendedprice AS DECIMAL(12,2))"
TOTAL = f"CAST({GROSS} * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))"
DELIV = "date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"

ORDERS_RAW = f"""orders_raw AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_id,
         o_custkey AS customer_id,
         o_orderdate AS order_date,
         l_partkey AS product_id,
         p_type AS category,
         p_brand AS sub_category,
         l_extendedprice / l_quantity AS unit_price,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(round(l_discount * 100, 0) AS INTEGER) AS discount_pct,
         {GROSS} AS gross_amount,
         CAST({GROSS} - {TOTAL} AS DECIMAL(18,4)) AS discount_amount,
         {TOTAL} AS total_amount,
         o_orderpriority AS payment_method,
         CASE WHEN {DELIV} >= 0 THEN CAST({DELIV} AS DOUBLE) END AS delivery_days,
         CASE WHEN o_orderstatus = 'P' THEN 'Cancelled'
              WHEN l_returnflag = 'R' THEN 'Returned'
              ELSE 'Delivered' END AS order_status,
         l_shipdate AS ship_date, l_suppkey AS supplier_id, l_extendedprice AS line_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

ORDER_COLS = ("order_id, customer_id, order_date, product_id, category, sub_category, "
              "unit_price, quantity, discount_pct, gross_amount, discount_amount, "
              "total_amount, payment_method, delivery_days, order_status")

ORDERS_DEDUP = f"""orders_dedup AS (
  SELECT {ORDER_COLS} FROM orders_raw
  QUALIFY row_number() OVER (PARTITION BY order_id
                             ORDER BY ship_date, product_id, supplier_id, line_price) = 1)"""

ORDERS_FLAGGED = f"""orders_flagged AS (
  SELECT order_id, customer_id, order_date, product_id, category, sub_category,
         unit_price, quantity, discount_pct, gross_amount, discount_amount,
         total_amount, payment_method,
         coalesce(delivery_days, (SELECT median(delivery_days) FROM orders_dedup)) AS delivery_days,
         order_status,
         coalesce(order_status = 'Cancelled', false) AS is_cancelled,
         coalesce(order_status = 'Returned', false) AS is_returned
  FROM orders_dedup
  WHERE order_date IS NOT NULL AND customer_id IS NOT NULL AND total_amount IS NOT NULL)"""

ORDERS_CLEAN = """orders_clean AS (
  SELECT *,
         CAST(year(order_date) AS INTEGER) AS year,
         CAST(month(order_date) AS INTEGER) AS month,
         strftime(order_date, '%b') AS month_name,
         strftime(order_date, '%Y-%m') AS year_month,
         CAST(weekofyear(order_date) AS INTEGER) AS week,
         dayname(order_date) AS weekday,
         CAST(quarter(order_date) AS INTEGER) AS quarter
  FROM orders_flagged WHERE NOT is_cancelled)"""

CUSTOMERS_RAW = """customers_base AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         CASE WHEN c_custkey % 100 < 48 THEN 'Male'
              WHEN c_custkey % 100 < 97 THEN 'Female' ELSE 'Other' END AS gender,
         CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE CAST(18 + c_custkey % 47 AS DOUBLE) END AS age,
         n_name AS city,
         CAST(DATE '1994-01-01' + CAST(c_custkey * 37 % 1800 AS INTEGER) AS TIMESTAMP) AS signup_date,
         r_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
customers_raw AS (
  SELECT * FROM customers_base
  UNION ALL SELECT * FROM customers_base WHERE customer_id % 200 = 0)"""

CUSTOMERS_CLEAN = """customers_dedup AS (
  SELECT * FROM customers_raw
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY signup_date, customer_name) = 1),
customers_clean AS (
  SELECT customer_id, customer_name, gender,
         coalesce(age, (SELECT median(age) FROM customers_dedup)) AS age,
         city, signup_date, state
  FROM customers_dedup)"""

SESSIONS_V = """sessions_v AS (
  SELECT event_id AS session_id, user_id AS customer_id, ts AS visit_date,
         event_type AS device,
         1 + CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS pages_viewed,
         value AS session_duration_min,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS converted
  FROM events)"""

PRODUCTS_V = """products_v AS (
  SELECT p_partkey AS product_id, p_type AS category, p_brand AS sub_category,
         p_name AS product_name, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price
  FROM part)"""

CTE = {
    "orders_raw": (ORDERS_RAW, []),
    "orders_dedup": (ORDERS_DEDUP, ["orders_raw"]),
    "orders_flagged": (ORDERS_FLAGGED, ["orders_dedup"]),
    "orders_clean": (ORDERS_CLEAN, ["orders_flagged"]),
    "customers_raw": (CUSTOMERS_RAW, []),
    "customers_clean": (CUSTOMERS_CLEAN, ["customers_raw"]),
    "sessions_v": (SESSIONS_V, []),
    "products_v": (PRODUCTS_V, []),
}


def with_ctes(needs: list[str], body: str, extra: list[tuple[str, list[str]]] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    table = dict(CTE)
    for sql, deps in (extra or []):
        name = sql.split(" AS (", 1)[0].strip()
        table[name] = (sql, deps)
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in table[n][1]:
            visit(d)
        order.append(n)

    for n in list(needs) + [sql.split(" AS (", 1)[0].strip() for sql, _ in (extra or [])]:
        visit(n)
    return "WITH " + ",\n".join(table[n][0] for n in order) + "\n" + body


SQL: dict[str, str] = {}


def stable_mean(col: str) -> str:
    """Mean from sums of the multiples of 2^-20 in each value and of the rests."""
    x = f"CAST({col} AS DOUBLE)"
    grid = f"CASE WHEN abs({x}) < 4398046511104 THEN floor({x} * 1048576.0::DOUBLE) / 1048576.0::DOUBLE ELSE {x} END"
    return f"(sum({grid}) + sum({x} - {grid})) / count({col})"


def interpolated(p: float) -> str:
    """Quantile p of x from its zero-based rank rn among n values of the group."""
    lo = f"max(x) FILTER (WHERE rn = floor({p}::DOUBLE * (n - 1)))"
    hi = f"max(x) FILTER (WHERE rn = ceil({p}::DOUBLE * (n - 1)))"
    return f"{lo} + ({hi} - {lo}) * max({p}::DOUBLE * (n - 1) - floor({p}::DOUBLE * (n - 1)))"


def register(name: str, needs: list[str], body: str, extra=None) -> None:
    SQL[name] = with_ctes(needs, body, extra)


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------

register("clean_orders", ["orders_clean"], """
SELECT * REPLACE (CAST(gross_amount AS DOUBLE) AS gross_amount,
                  CAST(discount_amount AS DOUBLE) AS discount_amount,
                  CAST(total_amount AS DOUBLE) AS total_amount)
FROM orders_clean""")
register("clean_customers", ["customers_clean"], "SELECT * FROM customers_clean")
register("monthly_trend", ["orders_clean"], """
SELECT year_month,
       CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS revenue,
       count(DISTINCT order_id) AS orders,
       count(DISTINCT customer_id) AS customers,
       CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value
FROM orders_clean GROUP BY year_month ORDER BY year_month""")

SNAPSHOT = "(SELECT max(order_date) + INTERVAL 1 DAY FROM orders_clean)"


def days_floor(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch({later}) - epoch({earlier})) / 86400) AS BIGINT)"


register("rfm", ["orders_clean"], f"""
SELECT customer_id,
       {days_floor(SNAPSHOT, 'max(order_date)')} AS recency_days,
       count(DISTINCT order_id) AS frequency,
       CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS monetary
FROM orders_clean GROUP BY customer_id""")

FAVORITE = """fav AS (
  SELECT customer_id, category AS favorite_category FROM (
    SELECT customer_id, category, count(*) AS n FROM orders_clean
    WHERE category IS NOT NULL GROUP BY customer_id, category)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, category) = 1)"""

BEHAVIOR = """behavior AS (
  SELECT o.customer_id,
         CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
         CAST(coalesce(sum(quantity), 0) AS BIGINT) AS total_quantity,
         avg(quantity) AS avg_basket_size,
         avg(CASE WHEN discount_pct > 0 THEN 1.0 ELSE 0.0 END) AS discount_usage_rate,
         avg(discount_pct) AS avg_discount_pct,
         coalesce(any_value(f.favorite_category), 'Unknown') AS favorite_category,
         count(DISTINCT category) AS category_diversity,
         avg(CAST(is_returned AS DOUBLE)) AS return_rate,
         min(order_date) AS first_purchase,
         max(order_date) AS last_purchase
  FROM orders_clean o LEFT JOIN fav f ON o.customer_id = f.customer_id
  GROUP BY o.customer_id)"""

register("behavior", ["orders_clean"], "SELECT * FROM behavior",
         extra=[(FAVORITE, ["orders_clean"]), (BEHAVIOR, ["orders_clean", "fav"])])

INTERVALS = """intervals AS (
  SELECT customer_id, avg(gap) AS avg_purchase_interval_days FROM (
    SELECT customer_id,
           floor((epoch(order_date) - epoch(lag(order_date) OVER (
                 PARTITION BY customer_id ORDER BY order_date))) / 86400) AS gap
    FROM orders_clean)
  GROUP BY customer_id)"""

register("purchase_intervals", ["orders_clean"], "SELECT * FROM intervals",
         extra=[(INTERVALS, ["orders_clean"])])

WEB = f"""web AS (
  SELECT customer_id,
         count(DISTINCT session_id) AS total_sessions,
         avg(pages_viewed) AS avg_pages_viewed,
         {stable_mean('session_duration_min')} AS avg_session_duration,
         avg(converted) AS conversion_rate
  FROM sessions_v WHERE customer_id IS NOT NULL GROUP BY customer_id)"""

register("web_features", ["sessions_v"], "SELECT * FROM web", extra=[(WEB, ["sessions_v"])])

FEATURES = f"""features AS (
  SELECT r.customer_id, r.recency_days, r.frequency, r.monetary,
         b.avg_order_value, b.total_quantity, b.avg_basket_size, b.discount_usage_rate,
         b.avg_discount_pct, b.favorite_category, b.category_diversity, b.return_rate,
         b.first_purchase, b.last_purchase,
         coalesce(i.avg_purchase_interval_days,
                  (SELECT median(avg_purchase_interval_days) FROM intervals)) AS avg_purchase_interval_days,
         CAST(coalesce(w.total_sessions, 0) AS BIGINT) AS total_sessions,
         coalesce(w.avg_pages_viewed, 0) AS avg_pages_viewed,
         coalesce(w.avg_session_duration, 0) AS avg_session_duration,
         coalesce(w.conversion_rate, 0) AS conversion_rate,
         c.customer_name, c.gender, c.age, c.city, c.state, c.signup_date,
         {days_floor(SNAPSHOT, 'c.signup_date')} AS tenure_days
  FROM ({'SELECT customer_id, ' + days_floor(SNAPSHOT, 'max(order_date)') + ' AS recency_days, count(DISTINCT order_id) AS frequency, CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS monetary FROM orders_clean GROUP BY customer_id'}) r
  LEFT JOIN behavior b ON r.customer_id = b.customer_id
  LEFT JOIN intervals i ON r.customer_id = i.customer_id
  LEFT JOIN web w ON r.customer_id = w.customer_id
  LEFT JOIN customers_clean c ON r.customer_id = c.customer_id)"""

FEATURE_DEPS = [(FAVORITE, ["orders_clean"]), (BEHAVIOR, ["orders_clean", "fav"]),
                (INTERVALS, ["orders_clean"]), (WEB, ["sessions_v"]),
                (FEATURES, ["orders_clean", "customers_clean", "behavior", "intervals", "web"])]

register("customer_features", ["features"], "SELECT * FROM features", extra=FEATURE_DEPS)

MONEY_SUM = "CAST(coalesce(sum(total_amount), 0) AS DOUBLE)"
MONEY_MEAN = "CAST(sum(total_amount) AS DOUBLE) / count(total_amount)"
WEEKDAY_DOMAIN = """weekdays AS (
  SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'),
                        (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) AS t(pos, weekday))"""

register("weekday_trend", ["orders_clean"], f"""
SELECT d.weekday, a.revenue, a.orders FROM weekdays d LEFT JOIN (
  SELECT weekday, {MONEY_SUM} AS revenue, count(DISTINCT order_id) AS orders
  FROM orders_clean GROUP BY weekday) a ON d.weekday = a.weekday ORDER BY d.pos""",
         extra=[(WEEKDAY_DOMAIN, [])])

register("category_monthly_trend", ["orders_clean"], f"""
SELECT year_month, category, {MONEY_SUM} AS total_amount
FROM orders_clean WHERE category IS NOT NULL GROUP BY year_month, category""")

register("new_customers_trend", ["orders_clean"], """
SELECT strftime(first, '%Y-%m') AS year_month, count(*) AS new_customers FROM (
  SELECT customer_id, min(order_date) AS first FROM orders_clean GROUP BY customer_id)
GROUP BY 1""")

register("quarterly_trend", ["orders_clean"], f"""
SELECT year, quarter, {MONEY_SUM} AS revenue, count(DISTINCT order_id) AS orders,
       'Q' || CAST(quarter AS VARCHAR) || ' ' || CAST(year AS VARCHAR) AS label
FROM orders_clean GROUP BY year, quarter""")

ORDERS_VALID = f"""orders_valid AS (
  SELECT {ORDER_COLS}, coalesce(order_status = 'Returned', false) AS is_returned
  FROM orders_raw WHERE order_status IS DISTINCT FROM 'Cancelled')"""

register("dashboard_monthly_trend", ["orders_raw"], f"""
SELECT strftime(order_date, '%Y-%m') AS year_month, {MONEY_SUM} AS revenue,
       count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers
FROM orders_valid GROUP BY 1""", extra=[(ORDERS_VALID, ["orders_raw"])])

register("dashboard_weekday_revenue", ["orders_raw"], f"""
SELECT d.weekday, a.revenue FROM weekdays d LEFT JOIN (
  SELECT dayname(order_date) AS weekday, {MONEY_SUM} AS revenue
  FROM orders_valid GROUP BY 1) a ON d.weekday = a.weekday ORDER BY d.pos""",
         extra=[(ORDERS_VALID, ["orders_raw"]), (WEEKDAY_DOMAIN, [])])

register("time_features", ["orders_clean"], """
SELECT order_id, order_date, year, month, month_name, year_month, week, weekday, quarter
FROM orders_clean""")

register("eda_kpis", ["orders_clean"], f"""
SELECT {MONEY_SUM} AS total_revenue, count(DISTINCT order_id) AS total_orders,
       count(DISTINCT customer_id) AS total_customers, {MONEY_MEAN} AS avg_order_value,
       avg(CAST(is_returned AS DOUBLE)) AS return_rate_overall,
       strftime(min(order_date), '%Y-%m-%d') AS date_min,
       strftime(max(order_date), '%Y-%m-%d') AS date_max
FROM orders_clean""")

register("eda_kpis_raw", ["orders_raw"], f"""
SELECT {MONEY_SUM} AS total_revenue, count(DISTINCT order_id) AS total_orders,
       count(DISTINCT customer_id) AS active_customers, {MONEY_MEAN} AS avg_order_value,
       avg(CAST(is_returned AS DOUBLE)) AS return_rate
FROM orders_valid""", extra=[(ORDERS_VALID, ["orders_raw"])])

register("revenue_by_category", ["orders_clean"], """
SELECT category, round_even(CAST(sum(total_amount) AS DOUBLE) * 100, 0) / 100 AS revenue
FROM orders_clean WHERE category IS NOT NULL GROUP BY category""")

register("orders_by_payment", ["orders_clean"], """
SELECT payment_method, count(*) AS orders FROM orders_clean
WHERE payment_method IS NOT NULL GROUP BY payment_method""")

register("orders_by_weekday", ["orders_clean"], """
SELECT weekday, count(*) AS orders FROM orders_clean
WHERE weekday IS NOT NULL GROUP BY weekday""")

RFM = f"""rfm AS (
  SELECT customer_id,
         {days_floor(SNAPSHOT, 'max(order_date)')} AS recency_days,
         count(DISTINCT order_id) AS frequency,
         CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS monetary
  FROM orders_clean GROUP BY customer_id)"""

register("rfm_stats", ["orders_clean"], f"""
SELECT avg(recency_days) AS recency_days_mean, median(recency_days) AS recency_days_median,
       avg(frequency) AS frequency_mean, median(frequency) AS frequency_median,
       {stable_mean('monetary')} AS monetary_mean, median(monetary) AS monetary_median
FROM rfm""", extra=[(RFM, ["orders_clean"])])

register("cleaning_audit", ["orders_raw", "customers_raw"], """
SELECT * FROM (
  SELECT 'customers' AS table_name, 'rows_loaded' AS metric, (SELECT count(*) FROM customers_raw) AS value
  UNION ALL SELECT 'customers', 'duplicates_removed',
    (SELECT count(*) FROM customers_raw) - (SELECT count(*) FROM (SELECT DISTINCT customer_id FROM customers_raw))
  UNION ALL SELECT 'customers', 'ages_imputed', (SELECT count(*) FROM customers_dedup WHERE age IS NULL)
  UNION ALL SELECT 'customers', 'rows_kept', (SELECT count(*) FROM customers_dedup)
  UNION ALL SELECT 'orders', 'rows_loaded', (SELECT count(*) FROM orders_raw)
  UNION ALL SELECT 'orders', 'duplicates_removed', (SELECT count(*) FROM orders_raw) - (SELECT count(*) FROM orders_dedup)
  UNION ALL SELECT 'orders', 'delivery_days_imputed', (SELECT count(*) FROM orders_dedup WHERE delivery_days IS NULL)
  UNION ALL SELECT 'orders', 'null_rows_dropped', (SELECT count(*) FROM orders_dedup
      WHERE order_date IS NULL OR customer_id IS NULL OR total_amount IS NULL)
  UNION ALL SELECT 'orders', 'cancellations_excluded', (SELECT count(*) FROM orders_flagged WHERE is_cancelled)
  UNION ALL SELECT 'orders', 'rows_kept', (SELECT count(*) FROM orders_flagged WHERE NOT is_cancelled))""",
         extra=[("""customers_dedup AS (
  SELECT * FROM customers_raw
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY signup_date, customer_name) = 1)""", ["customers_raw"]),
                (ORDERS_DEDUP, ["orders_raw"]), (ORDERS_FLAGGED, ["orders_dedup"])])

register("load_report", ["customers_raw", "products_v", "orders_raw", "sessions_v"], """
SELECT 'customers' AS table_name, count(*) AS rows FROM customers_raw
UNION ALL SELECT 'products', count(*) FROM products_v
UNION ALL SELECT 'orders', count(*) FROM orders_raw
UNION ALL SELECT 'sessions', count(*) FROM sessions_v""")

register("null_status_filter", ["orders_dedup"], """
SELECT order_id, order_status, is_cancelled, is_returned FROM (
  SELECT order_id, order_status,
         coalesce(order_status = 'Cancelled', false) AS is_cancelled,
         coalesce(order_status = 'Returned', false) AS is_returned
  FROM (SELECT order_id, order_date, customer_id, total_amount,
               CASE WHEN order_id % 7 <> 0 THEN order_status END AS order_status
        FROM orders_dedup)
  WHERE order_date IS NOT NULL AND customer_id IS NOT NULL AND total_amount IS NOT NULL)
WHERE order_status IS DISTINCT FROM 'Cancelled'""")

def _periods(table: str, counts: str) -> str:
    key = {"month": "strftime(order_date, '%Y-%m')", "quarter": "year(order_date)::VARCHAR || '-Q' || quarter(order_date)::VARCHAR",
           "year": "year(order_date)::VARCHAR", "total": "'all'"}
    return "\nUNION ALL\n".join(f"SELECT '{g}' AS grain, {k} AS period, {counts} FROM {table} GROUP BY {k}" for g, k in key.items())


register("distinct_rollup", ["orders_clean"], _periods("orders_clean", "count(DISTINCT customer_id) AS customers"))
register("distinct_rollup_raw", [], _periods("orders_valid", "count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders"),
         extra=[(ORDERS_VALID, ["orders_raw"])])
register("calendar_cube", ["orders_clean"], f"""
SELECT 'month' AS trend, year_month AS period, NULL::VARCHAR AS category, {MONEY_SUM} AS revenue, count(order_id) AS orders,
       count(DISTINCT customer_id) AS customers, CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value,
       NULL::BIGINT AS new_customers FROM orders_clean GROUP BY year_month
UNION ALL SELECT 'weekday', d.weekday, NULL, a.revenue, a.orders, NULL, NULL, NULL FROM weekdays d LEFT JOIN (
  SELECT weekday, {MONEY_SUM} AS revenue, count(order_id) AS orders FROM orders_clean GROUP BY weekday) a ON d.weekday = a.weekday
UNION ALL SELECT 'month_category', year_month, category, {MONEY_SUM}, NULL, NULL, NULL, NULL FROM orders_clean
  WHERE category IS NOT NULL GROUP BY year_month, category
UNION ALL SELECT 'new_customers', strftime(first, '%Y-%m'), NULL, NULL, NULL, NULL, NULL, count(*) FROM (
  SELECT customer_id, min(order_date) AS first FROM orders_clean GROUP BY customer_id) GROUP BY 2
UNION ALL SELECT 'quarter', 'Q' || quarter || ' ' || year, NULL, {MONEY_SUM}, count(order_id), NULL, NULL, NULL FROM orders_clean
  GROUP BY year, quarter""", extra=[(WEEKDAY_DOMAIN, [])])

# ---------------------------------------------------------------------------
# segments on the fixed cluster column customer_id % 5
# ---------------------------------------------------------------------------


def _avg_rank(col: str) -> str:
    """pandas rank(): mean position of the tie group, by counting."""
    return (f"((SELECT count(*) FROM prof q WHERE q.{col} < p.{col}) + "
            f"((SELECT count(*) FROM prof q WHERE q.{col} = p.{col}) + 1) / 2.0)")


CLUSTERED = """clustered AS (SELECT *, CAST(customer_id % 5 AS INTEGER) AS cluster FROM features)"""
PROF = f"""prof AS (
  SELECT cluster, count(*) AS customers,
         avg(recency_days) AS recency_days, avg(frequency) AS frequency,
         {stable_mean('monetary')} AS monetary, avg(tenure_days) AS tenure_days,
         {stable_mean('discount_usage_rate')} AS discount_usage_rate
  FROM clustered GROUP BY cluster)"""
MAPPING = """rules AS (
  SELECT 1 AS ord, 'High Value Customers' AS segment,
         (SELECT cluster FROM prof ORDER BY monetary DESC, cluster LIMIT 1) AS cluster
  UNION ALL SELECT 2, 'New Customers', (SELECT cluster FROM prof ORDER BY tenure_days ASC, cluster LIMIT 1)
  UNION ALL SELECT 3, 'At Risk / Inactive Customers',
         (SELECT cluster FROM prof ORDER BY recency_days DESC, cluster LIMIT 1)
  UNION ALL SELECT 4, 'Price Sensitive Customers',
         (SELECT cluster FROM prof ORDER BY discount_usage_rate DESC, cluster LIMIT 1)),
assigned AS (SELECT cluster, arg_min(segment, ord) AS segment FROM rules GROUP BY cluster),
pool AS (SELECT * FROM (VALUES (0, 'High Value Customers'), (1, 'Occasional Buyers'), (2, 'New Customers'),
                               (3, 'Price Sensitive Customers'), (4, 'At Risk / Inactive Customers')) t(pos, segment)),
free_names AS (SELECT segment, row_number() OVER (ORDER BY pos) AS rn FROM pool
               WHERE segment NOT IN (SELECT segment FROM assigned)),
free_clusters AS (SELECT cluster, row_number() OVER (ORDER BY cluster) AS rn FROM prof
                  WHERE cluster NOT IN (SELECT cluster FROM assigned)),
mapping AS (
  SELECT p.cluster, coalesce(a.segment, fn.segment, 'Occasional Buyers') AS segment
  FROM prof p LEFT JOIN assigned a ON p.cluster = a.cluster
  LEFT JOIN free_clusters fc ON p.cluster = fc.cluster
  LEFT JOIN free_names fn ON fc.rn = fn.rn)"""
SEG = """seg AS (SELECT c.*, m.segment FROM clustered c LEFT JOIN mapping m ON c.cluster = m.cluster)"""

SEG_MEANS = f"""seg_means AS (
  SELECT segment, count(customer_id) AS customers,
         avg(recency_days) AS avg_recency_days, avg(frequency) AS avg_frequency,
         {stable_mean('monetary')} AS avg_monetary, {stable_mean('avg_order_value')} AS avg_order_value,
         {stable_mean('avg_basket_size')} AS avg_basket_size,
         {stable_mean('discount_usage_rate')} AS discount_usage_rate,
         {stable_mean('return_rate')} AS return_rate, avg(category_diversity) AS category_diversity,
         {stable_mean('conversion_rate')} AS conversion_rate
  FROM seg GROUP BY segment),
seg_top AS (
  SELECT segment, favorite_category AS top_category FROM (
    SELECT segment, favorite_category, count(*) AS n FROM seg
    WHERE favorite_category IS NOT NULL GROUP BY segment, favorite_category)
  QUALIFY row_number() OVER (PARTITION BY segment ORDER BY n DESC, favorite_category) = 1),
summary AS (
  SELECT m.segment, customers,
         round_even(avg_recency_days * 100, 0) / 100 AS avg_recency_days, round_even(avg_frequency * 100, 0) / 100 AS avg_frequency,
         round_even(avg_monetary * 100, 0) / 100 AS avg_monetary, round_even(avg_order_value * 100, 0) / 100 AS avg_order_value,
         round_even(avg_basket_size * 100, 0) / 100 AS avg_basket_size, round_even(discount_usage_rate * 100, 0) / 100 AS discount_usage_rate,
         round_even(return_rate * 100, 0) / 100 AS return_rate, round_even(category_diversity * 100, 0) / 100 AS category_diversity,
         round_even(conversion_rate * 100, 0) / 100 AS conversion_rate,
         round_even(customers / sum(customers) OVER () * 100 * 10, 0) / 10 AS pct_of_customers,
         round_even((round_even(avg_monetary * 100, 0) / 100) * customers
                    / sum((round_even(avg_monetary * 100, 0) / 100) * customers) OVER () * 100 * 10, 0) / 10
             AS pct_of_revenue,
         t.top_category
  FROM seg_means m LEFT JOIN seg_top t ON m.segment IS NOT DISTINCT FROM t.segment)"""

SEG_DEPS = FEATURE_DEPS + [(CLUSTERED, ["features"]), (PROF, ["clustered"]),
                           (MAPPING, ["prof"]), (SEG, ["clustered", "rules"])]
SUMMARY_DEPS = SEG_DEPS + [(SEG_MEANS, ["seg"])]

register("cluster_profile", [], f"""
SELECT p.*, -{_avg_rank('recency_days')} + {_avg_rank('frequency')} + {_avg_rank('monetary')} AS score
FROM prof p""", extra=FEATURE_DEPS + [(CLUSTERED, ["features"]), (PROF, ["clustered"])])

register("label_clusters", [], """
SELECT cluster, segment, count(*) AS customers FROM seg GROUP BY cluster, segment""", extra=SEG_DEPS)

register("segmented_features", [], "SELECT * FROM seg", extra=SEG_DEPS)

register("segment_summary", [], "SELECT * FROM summary", extra=SUMMARY_DEPS)

register("segment_sizes", [], """
SELECT segment, customers, customers = max(customers) OVER ()
       AND segment = min(segment) FILTER (WHERE customers = mx) OVER () AS is_largest
FROM (SELECT segment, count(*) AS customers, max(count(*)) OVER () AS mx
      FROM seg WHERE segment IS NOT NULL GROUP BY segment)""", extra=SEG_DEPS)

register("segment_leaders", [], f"""
WITH means AS (
  SELECT segment, avg(recency_days) AS recency_days, avg(frequency) AS frequency,
         {stable_mean('monetary')} AS monetary FROM seg GROUP BY segment)
SELECT * FROM (SELECT 'most_recent' AS metric, segment, CAST(recency_days AS DOUBLE) AS value FROM means
               WHERE recency_days IS NOT NULL ORDER BY recency_days ASC, segment LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'most_frequent', segment, frequency FROM means
               WHERE frequency IS NOT NULL ORDER BY frequency DESC, segment LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'highest_spend', segment, monetary FROM means
               WHERE monetary IS NOT NULL ORDER BY monetary DESC, segment LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'highest_order_value', segment, avg_order_value FROM summary
               WHERE avg_order_value IS NOT NULL ORDER BY avg_order_value DESC, segment LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'highest_discount_usage', segment, discount_usage_rate FROM summary
               WHERE discount_usage_rate IS NOT NULL ORDER BY discount_usage_rate DESC, segment LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'highest_return_rate', segment, return_rate FROM summary
               WHERE return_rate IS NOT NULL ORDER BY return_rate DESC, segment LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'most_diverse', segment, category_diversity FROM summary
               WHERE category_diversity IS NOT NULL ORDER BY category_diversity DESC, segment LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'largest_segment', segment, CAST(customers AS DOUBLE) FROM summary
               WHERE customers IS NOT NULL ORDER BY customers DESC, segment LIMIT 1)""".replace(
    "\nWITH means AS (", "\n, means AS (", 1), extra=SUMMARY_DEPS)

_BOX = []
for _m in ["recency_days", "frequency", "monetary"]:
    _BOX.append(f"""SELECT q.segment, '{_m}' AS metric, min(CAST(s.{_m} AS DOUBLE)) AS min,
       q.q1, q.median, q.q3,
       max(CAST(s.{_m} AS DOUBLE)) AS max,
       min(CAST(s.{_m} AS DOUBLE)) FILTER (WHERE s.{_m} >= q.q1 - 1.5 * (q.q3 - q.q1)) AS lower_whisker,
       max(CAST(s.{_m} AS DOUBLE)) FILTER (WHERE s.{_m} <= q.q3 + 1.5 * (q.q3 - q.q1)) AS upper_whisker
FROM (SELECT segment, {interpolated(0.25)} AS q1, {interpolated(0.5)} AS median, {interpolated(0.75)} AS q3
      FROM (SELECT segment, CAST({_m} AS DOUBLE) AS x, row_number() OVER (PARTITION BY segment ORDER BY {_m}) - 1 AS rn,
                   count(*) OVER (PARTITION BY segment) AS n
            FROM seg WHERE {_m} IS NOT NULL) GROUP BY segment) q
JOIN seg s ON s.segment IS NOT DISTINCT FROM q.segment
GROUP BY q.segment, q.q1, q.median, q.q3""")
register("segment_box_stats", [], "\nUNION ALL\n".join(_BOX), extra=SEG_DEPS)

register("segment_pref_category", [], """
SELECT segment, favorite_category, count(*) AS customers FROM seg GROUP BY segment, favorite_category""",
         extra=SEG_DEPS)

register("segment_profile", [], """
SELECT segment, customers, pct_of_customers AS "% of Customers", pct_of_revenue AS "% of Revenue",
       avg_recency_days AS "Avg Recency (days)", avg_frequency AS "Avg Orders",
       avg_monetary AS "Avg Lifetime Spend (₹)", avg_order_value AS "Avg Order Value (₹)",
       top_category AS "Top Category"
FROM summary""", extra=SUMMARY_DEPS)

_RADAR = ["avg_recency_days", "avg_frequency", "avg_monetary", "avg_order_value", "category_diversity"]
register("segment_radar", [], "\nUNION ALL\n".join(
    f"SELECT segment, '{m}' AS metric, ({m} - min({m}) OVER ()) / (max({m}) OVER () - min({m}) OVER () + 1e-9) AS norm FROM summary"
    for m in _RADAR), extra=SUMMARY_DEPS)

_PICK = "picked AS (SELECT * FROM summary WHERE segment IN ('High Value Customers', 'At Risk / Inactive Customers', 'No Such Segment'))"
_PROFILE = [("customers", "customers"), ("pct_of_customers", "% of Customers"), ("pct_of_revenue", "% of Revenue"),
            ("avg_recency_days", "Avg Recency (days)"), ("avg_frequency", "Avg Orders"), ("avg_monetary", "Avg Lifetime Spend (₹)"),
            ("avg_order_value", "Avg Order Value (₹)")]
_SHOWN = [("profile", n, f"CAST({c} AS DOUBLE)") for c, n in _PROFILE] \
    + [("bars", c, c) for c in ("avg_order_value", "discount_usage_rate", "return_rate", "category_diversity")] \
    + [("radar", c, f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-9)") for c in _RADAR] \
    + [("shares", c, c) for c in ("pct_of_customers", "pct_of_revenue", "avg_monetary")] \
    + [("shares", "above_diagonal", "CAST(pct_of_revenue > pct_of_customers AS DOUBLE)")]
register("segment_selection", [], "\nUNION ALL\n".join(
    f"SELECT '{r}' AS result, segment, '{m}' AS metric, {v} AS value FROM picked" for r, m, v in _SHOWN), extra=SUMMARY_DEPS + [(_PICK, ["seg_means"])])

register("share_vs_customers", [], """
SELECT segment, pct_of_customers, pct_of_revenue, avg_monetary,
       pct_of_revenue > pct_of_customers AS above_diagonal FROM summary""", extra=SUMMARY_DEPS)

register("recency_spend_points", [], """
SELECT customer_id, customer_name, segment, recency_days, monetary, frequency, avg_order_value FROM seg""",
         extra=SEG_DEPS)

register("weekday_pattern", [], """
SELECT d.weekday, c.orders FROM weekdays d LEFT JOIN (
  SELECT dayname(order_date) AS weekday, count(*) AS orders FROM orders_valid
  WHERE customer_id IN (SELECT customer_id FROM seg WHERE customer_id IS NOT NULL)
  GROUP BY 1) c ON d.weekday = c.weekday ORDER BY d.pos""",
         extra=SEG_DEPS + [(ORDERS_VALID, ["orders_raw"]), (WEEKDAY_DOMAIN, [])])

register("customer_explorer", [], """
SELECT customer_id, customer_name, segment, recency_days, frequency, monetary, avg_order_value,
       favorite_category, city
FROM seg ORDER BY monetary DESC, customer_id LIMIT 200""", extra=SEG_DEPS)

register("domain_values", [], """
SELECT DISTINCT 'category' AS kind, category AS value FROM orders_valid WHERE category IS NOT NULL
UNION ALL
SELECT DISTINCT 'segment', segment FROM seg WHERE segment IS NOT NULL""",
         extra=SEG_DEPS + [(ORDERS_VALID, ["orders_raw"])])

# ---------------------------------------------------------------------------
# facts, growth, scaling, calendar windows, reconciliation
# ---------------------------------------------------------------------------

_DASH = [(ORDERS_VALID, ["orders_raw"]), (WEEKDAY_DOMAIN, [])]
PEAK = f"""monthly AS (
  SELECT year_month, {MONEY_SUM} AS revenue FROM orders_clean GROUP BY year_month),
rbc AS (SELECT category, round_even(CAST(sum(total_amount) AS DOUBLE) * 100, 0) / 100 AS revenue
        FROM orders_clean WHERE category IS NOT NULL GROUP BY category),
quarterly AS (SELECT year, quarter, 'Q' || CAST(quarter AS VARCHAR) || ' ' || CAST(year AS VARCHAR) AS label,
                     {MONEY_SUM} AS revenue FROM orders_clean GROUP BY year, quarter),
dash_wd AS (SELECT d.pos, d.weekday, a.revenue FROM weekdays d LEFT JOIN (
              SELECT dayname(order_date) AS weekday, {MONEY_SUM} AS revenue FROM orders_valid GROUP BY 1) a
            ON d.weekday = a.weekday),
dash_cat AS (SELECT category, {MONEY_SUM} AS revenue
             FROM orders_valid WHERE category IS NOT NULL GROUP BY category),
sizes AS (SELECT segment, count(*) AS customers FROM seg WHERE segment IS NOT NULL GROUP BY segment),
pref AS (SELECT segment, favorite_category, count(*) AS customers FROM seg GROUP BY 1, 2),
pattern AS (SELECT d.pos, d.weekday, c.orders FROM weekdays d LEFT JOIN (
              SELECT dayname(order_date) AS weekday, count(*) AS orders FROM orders_valid
              WHERE customer_id IN (SELECT customer_id FROM seg WHERE customer_id IS NOT NULL) GROUP BY 1) c
            ON d.weekday = c.weekday)"""

register("peak_facts", [], """
SELECT * FROM (SELECT 'peak_month' AS fact, year_month AS key, revenue AS value FROM monthly
               WHERE revenue IS NOT NULL ORDER BY revenue DESC, year_month LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'slowest_month', year_month, revenue FROM monthly
               WHERE revenue IS NOT NULL ORDER BY revenue ASC, year_month LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'top_category', category, revenue FROM rbc
               WHERE revenue IS NOT NULL ORDER BY revenue DESC, category LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'peak_quarter', label, revenue FROM quarterly
               WHERE revenue IS NOT NULL ORDER BY revenue DESC, year, quarter LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'peak_weekday', weekday, revenue FROM dash_wd
               WHERE revenue IS NOT NULL ORDER BY revenue DESC, pos LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'strongest_category', category, revenue FROM dash_cat
               WHERE revenue IS NOT NULL ORDER BY revenue DESC, category LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'largest_segment', segment, CAST(customers AS DOUBLE) FROM sizes
               ORDER BY customers DESC, segment LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'top_segment_category', concat_ws(' / ', segment, favorite_category),
               CAST(customers AS DOUBLE) FROM pref ORDER BY customers DESC, segment, favorite_category LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'busiest_purchase_day', weekday, CAST(orders AS DOUBLE) FROM pattern
               WHERE orders IS NOT NULL ORDER BY orders DESC, pos LIMIT 1)""",
         extra=SEG_DEPS + _DASH + [(PEAK, ["orders_clean", "orders_valid", "weekdays", "seg"])])


def _growth_sql(label: str, table: str, value: str) -> str:
    s, e = "start_value", "end_value"
    return f"""SELECT '{label}' AS label, points, {s}, {e},
       CASE WHEN points < 2 THEN 'stable' WHEN {e} > {s} THEN 'increased'
            WHEN {e} < {s} THEN 'fell' ELSE 'flat' END AS direction,
       CASE WHEN points < 2 THEN NULL WHEN {s} = 0 THEN 0.0
            WHEN {e} > {s} THEN ({e} - {s}) / {s} * 100
            WHEN {e} < {s} THEN ({s} - {e}) / {s} * 100 ELSE 0.0 END AS change_pct
FROM (SELECT count(*) AS points, CAST(arg_min({value}, year_month) AS DOUBLE) AS {s},
             CAST(arg_max({value}, year_month) AS DOUBLE) AS {e}
      FROM {table} WHERE {value} IS NOT NULL)"""


GROWTH_SERIES = f"""dash_monthly AS (
  SELECT strftime(order_date, '%Y-%m') AS year_month, {MONEY_SUM} AS revenue,
         count(DISTINCT order_id) AS orders FROM orders_valid GROUP BY 1),
new_cust AS (
  SELECT strftime(first, '%Y-%m') AS year_month, count(*) AS new_customers FROM (
    SELECT customer_id, min(order_date) AS first FROM orders_clean GROUP BY customer_id) GROUP BY 1)"""

register("growth", [], "\nUNION ALL\n".join([
    _growth_sql("Revenue", "dash_monthly", "revenue"),
    _growth_sql("Order volume", "dash_monthly", "orders"),
    _growth_sql("New customer acquisition", "new_cust", "new_customers")]),
    extra=[(ORDERS_VALID, ["orders_raw"]), (GROWTH_SERIES, ["orders_valid", "orders_clean"])])

_FEATS = ["recency_days", "frequency", "monetary", "avg_order_value", "avg_basket_size",
          "discount_usage_rate", "category_diversity"]
_LOGS = {"monetary", "frequency", "avg_order_value"}
_MATRIX = "matrix AS (SELECT customer_id, " + ", ".join(
    (f"ln(1 + coalesce(CAST({c} AS DOUBLE), 0)) AS {c}" if c in _LOGS
     else f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}") for c in _FEATS) + " FROM features)"
_STATS = "stats AS (SELECT " + ", ".join(
    f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in _FEATS) + " FROM matrix)"
register("feature_scaling", [], "SELECT customer_id, " + ", ".join(
    f"round(({c} - mu_{c}) / CASE WHEN sd_{c} IS NULL OR sd_{c} = 0 THEN 1 ELSE sd_{c} END, 6) AS {c}"
    for c in _FEATS) + " FROM matrix, stats",
    extra=FEATURE_DEPS + [(_MATRIX, ["features"]), (_STATS, ["matrix"])])

_ZED = "zed AS (SELECT customer_id, " + ", ".join(
    f"({c} - mu_{c}) / CASE WHEN sd_{c} IS NULL OR sd_{c} = 0 THEN 1 ELSE sd_{c} END AS x{i}"
    for i, c in enumerate(_FEATS)) + " FROM matrix, stats)"
_DIMS = range(len(_FEATS))
#: the documented centres: coordinate d of centre j is ((7j + 3d) mod 5 - 2) * 0.6
_CENTRES = "centres AS (SELECT kk.k, jj.j, " + ", ".join(
    f"((7 * jj.j + 3 * {d}) % 5 - 2) * 0.6::DOUBLE AS c{d}" for d in _DIMS) + """
  FROM (VALUES (2), (3), (5)) kk(k) JOIN (SELECT unnest(range(5)) AS j) jj ON jj.j < kk.k)"""
_NEAR = "near AS (SELECT * FROM (SELECT z.*, c.k, c.j, " + " + ".join(
    f"(x{d} - c{d}) * (x{d} - c{d})" for d in _DIMS) + """ AS dist,
         row_number() OVER (PARTITION BY z.customer_id, c.k ORDER BY """ + " + ".join(
    f"(x{d} - c{d}) * (x{d} - c{d})" for d in _DIMS) + """, c.j) AS rn
  FROM zed z, centres c) WHERE rn = 1)"""
_NEAR_DEPS = FEATURE_DEPS + [(_MATRIX, ["features"]), (_STATS, ["matrix"]), (_ZED, ["matrix", "stats"]),
                             (_CENTRES, []), (_NEAR, ["zed", "centres"])]

register("kmeans_fixed_labels", [], "SELECT customer_id, j::INTEGER AS cluster FROM near WHERE k = 5", extra=_NEAR_DEPS)

register("kmeans_fixed_metrics", [], f"""
, clus AS (SELECT k, j, count(*) AS n, {", ".join(f"sum(x{d}) AS s{d}" for d in _DIMS)},
                sum({" + ".join(f"x{d} * x{d}" for d in _DIMS)}) AS sq FROM near GROUP BY k, j),
mean_d AS (
  SELECT p.k, p.customer_id, p.j, c.j AS other, c.n,
         {" + ".join(f"x{d} * x{d}" for d in _DIMS)} + c.sq / c.n
         - 2 * ({" + ".join(f"x{d} * s{d}" for d in _DIMS)}) / c.n AS d
  FROM near p JOIN clus c ON c.k = p.k),
ab AS (SELECT k, customer_id, max(n) FILTER (WHERE other = j) AS n,
              max(d * n / (n - 1)) FILTER (WHERE other = j AND n > 1) AS a, min(d) FILTER (WHERE other <> j) AS b
       FROM mean_d GROUP BY k, customer_id),
sil AS (SELECT k, avg(CASE WHEN n = 1 THEN 0 WHEN a = b THEN 0 ELSE (b - a) / greatest(a, b) END) AS s FROM ab GROUP BY k)
SELECT i.k::INTEGER AS k, round(i.inertia, 2) AS inertia, round(s, 4) AS squared_silhouette
FROM (SELECT k, sum(dist) AS inertia FROM near GROUP BY k) i JOIN sil USING (k)""", extra=_NEAR_DEPS)

register("kmeans_lloyd_step", [], f"""
SELECT c.k::INTEGER AS k, c.j::INTEGER AS cluster,
       {", ".join(f"round(coalesce(m.x{d}, c.c{d}), 6) AS x{d}" for d in _DIMS)}
FROM centres c LEFT JOIN (SELECT k, j, {", ".join(f"avg(x{d}) AS x{d}" for d in _DIMS)} FROM near GROUP BY k, j) m
  ON m.k = c.k AND m.j = c.j
WHERE c.k IN (2, 5)""", extra=_NEAR_DEPS)

def _squared(a: str, b: str) -> str:
    return " + ".join(f"({a}{d} - {b}{d}) * ({a}{d} - {b}{d})" for d in _DIMS)


#: two centres out of reach: 100 and 101 in every coordinate
_FAR = "far_centres AS (SELECT 3 AS k, j, " + ", ".join(f"c{d}" for d in _DIMS) + " FROM centres WHERE k = 2 UNION ALL SELECT 3, 2, " + \
    ", ".join("100.0::DOUBLE" for _ in _DIMS) + " UNION ALL SELECT 5, j + 1, " + ", ".join(f"c{d}" for d in _DIMS) + \
    " FROM centres WHERE k = 3 UNION ALL SELECT 5, 0, " + ", ".join("100.0::DOUBLE" for _ in _DIMS) + \
    " UNION ALL SELECT 5, 4, " + ", ".join("101.0::DOUBLE" for _ in _DIMS) + ")"

# an empty cluster takes the farthest customer, who leaves the mean of the cluster it was in
register("kmeans_relocation_step", [], f"""
, placed AS (SELECT * FROM (SELECT z.*, c.k, c.j, {_squared('x', 'c')} AS dist,
           row_number() OVER (PARTITION BY z.customer_id, c.k ORDER BY {_squared('x', 'c')}, c.j) AS rn
         FROM zed z, far_centres c) WHERE rn = 1),
bare AS (SELECT k, j, row_number() OVER (PARTITION BY k ORDER BY j) AS turn FROM far_centres
         WHERE (k, j) NOT IN (SELECT (k, j) FROM placed)),
far AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY dist DESC, customer_id) AS turn FROM placed),
moved AS (SELECT f.k, f.customer_id, f.j AS was, b.j AS j, {", ".join(f"x{d}" for d in _DIMS)} FROM far f JOIN bare b ON b.k = f.k AND b.turn = f.turn),
stay AS (SELECT k, j, {", ".join(f"x{d}" for d in _DIMS)} FROM placed WHERE (k, customer_id) NOT IN (SELECT (k, customer_id) FROM moved)
         UNION ALL SELECT k, j, {", ".join(f"x{d}" for d in _DIMS)} FROM moved)
SELECT k::INTEGER AS k, j::INTEGER AS cluster, {", ".join(f"round(avg(x{d}), 6) AS x{d}" for d in _DIMS)} FROM stay GROUP BY k, j""",
         extra=_NEAR_DEPS + [(_FAR, ["centres"])])

register("kmeans_fixed_silhouette", [], f"""
, pairs AS (SELECT p.k, p.customer_id, p.j, q.j AS other, sum(sqrt({_squared('p.x', 'q.x')})) AS s, count(*) AS n
            FROM near p JOIN near q ON p.k = q.k GROUP BY p.k, p.customer_id, p.j, q.j),
ab AS (SELECT k, customer_id, max(n) FILTER (WHERE other = j) AS n,
              max(s / (n - 1)) FILTER (WHERE other = j AND n > 1) AS a, min(s / n) FILTER (WHERE other <> j) AS b
       FROM pairs GROUP BY k, customer_id)
SELECT k::INTEGER AS k, count(*) AS customers,
       round(avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 4) AS euclidean_silhouette
FROM ab GROUP BY k""", extra=_NEAR_DEPS)


def _documented_steps(steps: int) -> list[tuple[str, list[str]]]:
    """Lloyd steps from the five documented centres, one pair of tables per step."""
    xs, cs = [f"x{d}" for d in _DIMS], [f"c{d}" for d in _DIMS]
    out = [("cen0 AS (SELECT j, " + ", ".join(cs) + " FROM centres WHERE k = 5)", ["centres"])]
    for i in range(steps + 1):
        out.append((f"""near{i} AS (SELECT * FROM (SELECT z.*, c.j, row_number() OVER (PARTITION BY z.customer_id ORDER BY {_squared('x', 'c')}, c.j) AS rn
  FROM zed z, cen{i} c) WHERE rn = 1)""", ["zed", f"cen{i}"]))
        if i < steps:
            out.append((f"cen{i + 1} AS (SELECT j, " + ", ".join(f"avg({x}) AS {c}" for x, c in zip(xs, cs)) + f" FROM near{i} GROUP BY j)", [f"near{i}"]))
    return out


_DOCUMENTED = """clustered AS (
  SELECT f.*, CAST(o.cluster AS INTEGER) AS cluster FROM features f JOIN near4 n USING (customer_id) JOIN (
    SELECT j, row_number() OVER (ORDER BY m DESC, r, j) - 1 AS cluster
    FROM (SELECT j, """ + stable_mean("monetary") + """ AS m, avg(recency_days) AS r FROM features JOIN near4 USING (customer_id) GROUP BY j)) o ON o.j = n.j)"""
_DOCUMENTED_DEPS = FEATURE_DEPS + [(_MATRIX, ["features"]), (_STATS, ["matrix"]), (_ZED, ["matrix", "stats"]), (_CENTRES, [])] \
    + _documented_steps(4) + [(_DOCUMENTED, ["features", "near4"]), (PROF, ["clustered"]), (MAPPING, ["prof"]), (SEG, ["clustered", "rules"])]
register("kmeans_documented_fit", [], "SELECT customer_id, cluster, segment FROM seg", extra=_DOCUMENTED_DEPS)
register("kmeans_documented_summary", [], "SELECT * FROM summary", extra=_DOCUMENTED_DEPS + [(SEG_MEANS, ["seg"])])

_RUNNER_UP = """ru1 AS (SELECT cluster FROM prof WHERE monetary IS NOT NULL ORDER BY monetary DESC, cluster LIMIT 1),
ru2 AS (SELECT cluster FROM prof WHERE tenure_days IS NOT NULL AND cluster NOT IN (FROM ru1) ORDER BY tenure_days, cluster LIMIT 1),
ru3 AS (SELECT cluster FROM prof WHERE recency_days IS NOT NULL AND cluster NOT IN (FROM ru1) AND cluster NOT IN (FROM ru2)
        ORDER BY recency_days DESC, cluster LIMIT 1),
ru4 AS (SELECT cluster FROM prof WHERE discount_usage_rate IS NOT NULL AND cluster NOT IN (FROM ru1) AND cluster NOT IN (FROM ru2)
        AND cluster NOT IN (FROM ru3) ORDER BY discount_usage_rate DESC, cluster LIMIT 1),
assigned AS (SELECT cluster, 'High Value Customers' AS segment FROM ru1 UNION ALL SELECT cluster, 'New Customers' FROM ru2
             UNION ALL SELECT cluster, 'At Risk / Inactive Customers' FROM ru3 UNION ALL SELECT cluster, 'Price Sensitive Customers' FROM ru4),
""" + MAPPING[MAPPING.index("pool AS"):]
register("label_clusters_runner_up", [], "SELECT cluster, segment, count(*) AS customers FROM seg GROUP BY cluster, segment",
         extra=FEATURE_DEPS + [(CLUSTERED, ["features"]), (PROF, ["clustered"]), (_RUNNER_UP, ["prof"]), (SEG, ["clustered", "ru1"])])

WINDOWS = """win AS (
  SELECT * FROM (VALUES (101, 115, 1.3, 'early January'), (301, 320, 1.2, 'early March'),
                        (801, 831, 1.4, 'August'),
                        (1001, 1031, 1.8, 'October'), (1120, 1130, 1.6, 'late November'),
                        (1215, 1231, 1.5, 'late December')) t(s, e, boost, name))"""
DAILY = f"""daily AS (
  SELECT CAST(d AS TIMESTAMP) AS order_date, count(*) AS orders, {MONEY_SUM} AS revenue,
         month(d) * 100 + day(d) AS md
  FROM (SELECT *, CAST(order_date AS DATE) AS d FROM orders_clean) GROUP BY d),
tags AS (
  SELECT d.order_date, d.orders, d.revenue,
         (SELECT name FROM win WHERE d.md BETWEEN s AND e ORDER BY boost DESC LIMIT 1) AS season,
         coalesce((SELECT CAST(max(boost) AS DOUBLE) FROM win WHERE d.md BETWEEN s AND e), 1.0) AS multiplier
  FROM daily d)"""

register("seasonal_tags", [], "SELECT * FROM tags",
         extra=[(WINDOWS, []), (DAILY, ["orders_clean", "win"])])

register("demand_index", [], """
SELECT order_date, orders, revenue, multiplier, growth, multiplier * growth AS demand_index,
       revenue / (multiplier * growth) AS revenue_per_index
FROM (SELECT t.*, 1.0 + CASE WHEN date_diff('day', d0, d1) > 0
                             THEN date_diff('day', d0, order_date) / date_diff('day', d0, d1)
                             ELSE 0.0 END * 0.35 AS growth
      FROM tags t, (SELECT min(order_date) AS d0, max(order_date) AS d1 FROM tags))""",
         extra=[(WINDOWS, []), (DAILY, ["orders_clean", "win"])])

register("seasonal_range_join", ["orders_clean"], """
SELECT order_id, order_date, coalesce((SELECT CAST(max(boost) AS DOUBLE) FROM win
         WHERE month(order_date) * 100 + day(order_date) BETWEEN s AND e), 1.0) AS multiplier
FROM orders_clean""", extra=[(WINDOWS, [])])

register("amount_reconciliation", ["orders_dedup"], """
SELECT count(*) AS rows_checked,
       CAST(sum(CASE WHEN eg <> gross_amount THEN 1 ELSE 0 END) AS BIGINT) AS gross_mismatches,
       CAST(sum(CASE WHEN ed <> discount_amount THEN 1 ELSE 0 END) AS BIGINT) AS discount_mismatches,
       CAST(sum(CASE WHEN gross_amount - ed <> total_amount THEN 1 ELSE 0 END) AS BIGINT) AS total_mismatches,
       CAST(max(abs(gross_amount - ed - total_amount)) AS DOUBLE) AS max_total_diff
FROM (SELECT *, round(CAST(unit_price AS DECIMAL(20,6)) * quantity, 2) AS eg,
             round(gross_amount * discount_pct * CAST(0.01 AS DECIMAL(3,2)), 2) AS ed
      FROM orders_dedup)""")

register("append_dedup", ["orders_raw"], f"""
SELECT * REPLACE (CAST(gross_amount AS DOUBLE) AS gross_amount,
                  CAST(discount_amount AS DOUBLE) AS discount_amount,
                  CAST(total_amount AS DOUBLE) AS total_amount) FROM (
SELECT {ORDER_COLS} FROM (
  SELECT * FROM orders_raw UNION ALL SELECT * FROM orders_raw WHERE order_id % 3 = 0)
QUALIFY row_number() OVER (PARTITION BY order_id
                           ORDER BY ship_date, product_id, supplier_id, line_price) = 1)""")

# ---------------------------------------------------------------------------
# formatted text
# ---------------------------------------------------------------------------


def _sql_literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _growth_text_sql() -> str:
    """Sentences over the ``growth`` CTE (the numeric growth query)."""
    from basketry.plans.insights import GROWTH_TEXT
    pct = "printf('%.1f', change_pct)"
    st = "format('{:,.0f}', start_value)"
    en = "format('{:,.0f}', end_value)"
    return f"""SELECT label, CASE direction
  WHEN 'stable' THEN printf({_sql_literal(GROWTH_TEXT['stable'])}, label)
  WHEN 'increased' THEN printf({_sql_literal(GROWTH_TEXT['increased'])}, label, {pct}, {st}, {en})
  WHEN 'fell' THEN printf({_sql_literal(GROWTH_TEXT['fell'])}, label, {pct}, {st}, {en})
  ELSE printf({_sql_literal(GROWTH_TEXT['flat'])}, label) END AS text
FROM growth"""


# the growth statement reuses the growth query as a CTE
_head, _body = SQL["growth"][len("WITH "):].split("\nSELECT '", 1)
SQL["growth_statements"] = ("WITH " + _head + ",\ngrowth AS (SELECT '" + _body + ")\n"
                            + _growth_text_sql())


def _insights_sql() -> str:
    from basketry.plans.insights import INSIGHT_TEXT
    t = [_sql_literal(x) for x in INSIGHT_TEXT]
    return f"""
SELECT 1 AS n, printf({t[0]}, segment, CAST(pct_of_customers AS VARCHAR), CAST(pct_of_revenue AS VARCHAR)) AS text
FROM (SELECT * FROM summary WHERE avg_monetary IS NOT NULL ORDER BY avg_monetary DESC, segment LIMIT 1)
UNION ALL SELECT 2, printf({t[1]}, printf('%.0f', coalesce(
    (SELECT first(avg_recency_days) FROM summary WHERE segment = 'At Risk / Inactive Customers'), 0.0)))
UNION ALL SELECT 3, printf({t[2]}, (SELECT category FROM rbc WHERE revenue IS NOT NULL
                                    ORDER BY revenue DESC, category LIMIT 1))
UNION ALL SELECT 4, printf({t[3]}, b.year_month, format('{{:,.0f}}', b.revenue), w.year_month, format('{{:,.0f}}', w.revenue))
FROM (SELECT * FROM monthly WHERE revenue IS NOT NULL ORDER BY revenue DESC, year_month LIMIT 1) b,
     (SELECT * FROM monthly WHERE revenue IS NOT NULL ORDER BY revenue ASC, year_month LIMIT 1) w
UNION ALL SELECT 5, printf({t[4]}, printf('%.1f', (SELECT avg(CAST(is_returned AS DOUBLE)) FROM orders_clean) * 100))
UNION ALL SELECT 6, {t[5]}
UNION ALL SELECT 7, printf({t[6]}, '7')"""


register("insights", [], _insights_sql(),
         extra=SUMMARY_DEPS + _DASH + [(PEAK, ["orders_clean", "orders_valid", "weekdays", "seg"])])


def _payload_sql() -> str:
    """Every value of the payload from the statements of its parts."""
    rows = [f"SELECT 'eda_summary/{n}' AS path, NULL::VARCHAR AS text, CAST({n} AS DOUBLE) AS number FROM kpi"
            for n in ("total_revenue", "total_orders", "total_customers", "avg_order_value", "return_rate_overall")]
    rows += [f"SELECT 'eda_summary/date_range/{i}', {c}, NULL FROM kpi" for i, c in enumerate(("date_min", "date_max"))]
    rows += [f"SELECT 'eda_summary/rfm_stats/{m}/{s}', NULL, {m}_{s} FROM rfm" for m in ("recency_days", "frequency", "monetary") for s in ("mean", "median")]
    rows += [f"SELECT 'eda_summary/{n}/' || {k}, NULL, CAST({v} AS DOUBLE) FROM {t}" for n, k, v, t in (
        ("revenue_by_category", "category", "revenue", "by_category"), ("orders_by_payment_method", "payment_method", "orders", "by_payment"),
        ("orders_by_weekday", "weekday", "orders", "by_weekday"))]
    rows += [f"SELECT 'elbow_data/{n}/' || (row_number() OVER (ORDER BY k) - 1), NULL, CAST({c} AS DOUBLE) FROM metric JOIN sil USING (k)"
             for n, c in (("k", "k"), ("inertia", "inertia"), ("silhouette", "euclidean_silhouette"))]
    rows += ["SELECT 'cluster_mapping/' || cluster, segment, NULL FROM names", "SELECT 'insights/' || (n - 1), text, NULL FROM says"]
    parts = {"kpi": "eda_kpis", "rfm": "rfm_stats", "by_category": "revenue_by_category", "by_payment": "orders_by_payment",
             "by_weekday": "orders_by_weekday", "metric": "kmeans_fixed_metrics", "sil": "kmeans_fixed_silhouette", "names": "label_clusters", "says": "insights"}
    return "WITH " + ",\n".join(f"{a} AS ({SQL[b]})" for a, b in parts.items()) + "\n" + "\nUNION ALL\n".join(rows)


SQL["summary_payload_values"] = _payload_sql()
