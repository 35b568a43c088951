"""ANSI SQL (DuckDB dialect) equal to each registered query, over the driver's
tables registered as views. Used as the correctness oracle.

Rules: integer sums/counts cast to BIGINT; money summed as DECIMAL(28,6)
and cast to DOUBLE at the end; ratios divide two DOUBLEs; every LIMIT has a
full tie-break.
"""

from __future__ import annotations

from clickpulse.plans.catalog import (
    FUNNEL_CATEGORY,
    LIVE_SHOWN,
    LIVE_TOP,
    RANGE_END,
    RANGE_START,
    RATE_DIGITS,
    SAMPLE_FRACTION,
    SAMPLE_ROWS,
    TOP_ABANDONMENT,
    TOP_BRANDS,
    TOP_PRODUCTS,
    USER_RANGES,
)
from clickpulse.operators.affinity import DEFAULT_TOP_PAIRS
from clickpulse.operators.sampling import DEFAULT_SEED, session_threshold

ENRICHED = """
clicks AS (
  SELECT e.event_id,
         e.ts AS event_ts,
         CAST(e.ts AS DATE) AS date,
         CASE WHEN e.event_type = 'click' THEN 'cart' ELSE e.event_type END AS event_type,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS product_id,
         lower(p.p_type) || '.' || replace(p.p_name, ' ', '_') AS category_code,
         p.p_brand AS brand,
         e.value AS price,
         e.user_id,
         CAST(e.user_id AS VARCHAR) || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS user_session
  FROM events e
  LEFT JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
),
enriched AS (
  SELECT *,
         CASE WHEN category_code IS NOT NULL THEN split_part(category_code, '.', 1)
              ELSE 'unknown' END AS root_category
  FROM clicks
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([ENRICHED, *ctes]) + "\n"


def _cnt(t: str) -> str:
    return f"CAST(SUM(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT)"


REV = "SUM(CASE WHEN event_type = 'purchase' THEN TRY_CAST(price AS DECIMAL(28,6)) ELSE 0 END)"


def _ratio(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) ELSE 0.0 END"


MEASURES = f"""{_cnt('view')} AS views, {_cnt('cart')} AS carts, {_cnt('purchase')} AS purchases,
  {REV} AS revenue"""

DAILY = f"""daily AS (
  SELECT date,
         CAST(COUNT(*) AS BIGINT) AS total_events,
         CAST(COUNT(DISTINCT user_id) AS BIGINT) AS unique_users,
         {_cnt('view')} AS total_views,
         {_cnt('cart')} AS total_carts,
         {_cnt('purchase')} AS total_purchases,
         {REV} AS total_revenue
  FROM enriched GROUP BY date
),
daily_metrics AS (
  SELECT *, {_ratio('total_purchases', 'unique_users')} AS conversion_rate,
         {_ratio('total_revenue', 'total_purchases')} AS avg_order_value
  FROM daily
)"""

FUNNEL = f"""funnel AS (
  SELECT date, root_category AS category,
         {_cnt('view')} AS views, {_cnt('cart')} AS carts, {_cnt('purchase')} AS purchases
  FROM enriched GROUP BY date, root_category
),
funnel_stats AS (
  SELECT *, {_ratio('carts', 'views')} AS view_to_cart_rate,
         {_ratio('purchases', 'carts')} AS cart_to_purchase_rate
  FROM funnel
)"""

FLAGS = """flags AS (
  SELECT user_session, date, root_category,
         COALESCE(BOOL_OR(COALESCE(event_type = 'cart', false)), false) AS has_cart,
         COALESCE(BOOL_OR(COALESCE(event_type = 'purchase', false)), false) AS has_purchase
  FROM enriched GROUP BY user_session, date, root_category
)"""

ABANDON = f"""{FLAGS},
abandon AS (
  SELECT date, root_category AS category,
         CAST(SUM(CASE WHEN NOT has_purchase THEN 1 ELSE 0 END) AS BIGINT) AS abandoned_carts,
         CAST(SUM(CASE WHEN has_purchase THEN 1 ELSE 0 END) AS BIGINT) AS completed_purchases
  FROM flags WHERE has_cart GROUP BY date, root_category
),
cart_abandonment AS (
  SELECT *, {_ratio('abandoned_carts', 'abandoned_carts + completed_purchases')} AS abandonment_rate
  FROM abandon
)"""

SP = """sp AS (
  SELECT DISTINCT user_session AS session, product_id
  FROM enriched WHERE event_type IN ('view', 'cart')
)"""


def _affinity(source: str, session: str, types_filter: str, top: int | None) -> str:
    """Affinity CTEs over ``source`` (a CTE or table) with a session column."""
    limit = f"LIMIT {top}" if top is not None else ""
    return f"""asp AS (
  SELECT DISTINCT {session} AS session, product_id FROM {source} {types_filter}
),
pc AS (SELECT product_id, CAST(COUNT(*) AS BIGINT) AS session_count FROM asp GROUP BY product_id),
tot AS (
  SELECT CAST(COUNT(DISTINCT {session}) + COALESCE(MAX(CASE WHEN {session} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)
         AS total_sessions
  FROM {source}
),
co AS (
  SELECT a.product_id AS product_a, b.product_id AS product_b, CAST(COUNT(*) AS BIGINT) AS co_occurrences
  FROM asp a JOIN asp b ON a.session = b.session AND a.product_id < b.product_id
  GROUP BY a.product_id, b.product_id
),
scored AS (
  SELECT co.product_a, co.product_b, co.co_occurrences,
         (CAST(co.co_occurrences AS DOUBLE) * CAST(tot.total_sessions AS DOUBLE))
           / (CAST(pa.session_count AS DOUBLE) * CAST(pb.session_count AS DOUBLE)) AS lift
  FROM co JOIN pc pa ON pa.product_id = co.product_a
          JOIN pc pb ON pb.product_id = co.product_b
          CROSS JOIN tot
)
SELECT product_a, product_b, co_occurrences, lift FROM scored
ORDER BY lift DESC, product_a, product_b {limit}"""


def _range(col: str = "date") -> str:
    return f"{col} >= DATE '{RANGE_START}' AND {col} <= DATE '{RANGE_END}'"


def _money(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


FUNNEL_RANGE_ALL = f"""fr AS (
  SELECT CAST(COALESCE(SUM(views), 0) AS BIGINT) AS views,
         CAST(COALESCE(SUM(carts), 0) AS BIGINT) AS carts,
         CAST(COALESCE(SUM(purchases), 0) AS BIGINT) AS purchases
  FROM funnel_stats WHERE {_range()}
)"""

FR_RATES = f"""{_ratio('carts', 'views')} AS view_to_cart_rate,
  {_ratio('purchases', 'carts')} AS cart_to_purchase_rate,
  {_ratio('purchases', 'views')} AS overall_conversion"""

LIVE = """ranked AS (
  SELECT *,
         ROW_NUMBER() OVER (PARTITION BY user_session ORDER BY event_ts, event_id) AS rn_first,
         ROW_NUMBER() OVER (PARTITION BY user_session ORDER BY event_ts DESC, event_id DESC) AS rn_last
  FROM enriched
),
live AS (
  SELECT user_session AS session_id,
         MAX(CASE WHEN rn_first = 1 THEN user_id END) AS user_id,
         MAX(event_ts) AS last_event_time,
         CAST(COUNT(*) AS BIGINT) AS event_count,
         COALESCE(BOOL_OR(COALESCE(event_type = 'cart', false)), false) AS has_cart,
         COALESCE(BOOL_OR(COALESCE(event_type = 'purchase', false)), false) AS has_purchase,
         MAX(CASE WHEN rn_last = 1 THEN product_id END) AS last_product_id,
         MAX(CASE WHEN rn_last = 1 THEN category_code END) AS last_category
  FROM ranked GROUP BY user_session
)"""

CATEGORY_EVENTS = """SELECT trim(root_category) AS category, trim(event_type) AS event_type,
       CAST(COUNT(*) AS BIGINT) AS event_count
FROM enriched
WHERE trim(root_category) <> '' AND event_type IS NOT NULL AND trim(event_type) <> ''
GROUP BY 1, 2"""

BRAND_REVENUE = """SELECT trim(brand) AS brand,
       CAST(SUM(TRY_CAST(price AS DECIMAL(28,6))) AS DOUBLE) AS total_revenue,
       CAST(COUNT(*) AS BIGINT) AS purchase_count
FROM enriched
WHERE event_type = 'purchase' AND brand IS NOT NULL AND trim(brand) <> ''
  AND TRY_CAST(price AS DECIMAL(28,6)) IS NOT NULL
GROUP BY 1"""

ROUNDTRIP_COLUMNS = """SELECT event_type, product_id, category_code, brand, price, user_id, user_session,
       date_trunc('second', event_ts) AS event_ts, date, root_category
FROM enriched"""

SQL: dict[str, str] = {
    "enriched_events": _with()
    + """SELECT event_id, event_ts, date, event_type, product_id, category_code, brand, price,
       user_id, user_session, root_category FROM enriched""",
    "event_time_parse": """SELECT event_id,
       date_trunc('second', ts) AS batch_ts, date_trunc('second', ts) AS iso_ts,
       date_trunc('second', ts) AS either_from_batch, date_trunc('second', ts) AS either_from_iso,
       CAST(ts AS DATE) AS date
FROM events""",
    "daily_metrics": _with(DAILY)
    + f"""SELECT date, total_events, unique_users, total_views, total_carts, total_purchases,
       {_money('total_revenue')} AS total_revenue, conversion_rate, avg_order_value
FROM daily_metrics""",
    "top_products": _with()
    + f"""SELECT product_id, category_code AS category, brand, price,
       {_cnt('view')} AS views, {_cnt('cart')} AS carts, {_cnt('purchase')} AS purchases,
       CAST({REV} AS DOUBLE) AS revenue
FROM enriched GROUP BY product_id, category_code, brand, price""",
    "top_categories": _with()
    + f"""SELECT root_category AS category,
       {_cnt('view')} AS views, {_cnt('cart')} AS carts, {_cnt('purchase')} AS purchases,
       CAST({REV} AS DOUBLE) AS revenue
FROM enriched GROUP BY root_category""",
    "top_brands": _with()
    + f"""SELECT brand,
       {_cnt('view')} AS views, {_cnt('cart')} AS carts, {_cnt('purchase')} AS purchases,
       CAST({REV} AS DOUBLE) AS revenue
FROM enriched WHERE brand IS NOT NULL GROUP BY brand""",
    "funnel_stats": _with(FUNNEL) + "SELECT * FROM funnel_stats",
    "session_flags": _with(FLAGS) + "SELECT * FROM flags",
    "session_flags_session_grain": _with(
        """sess AS (
  SELECT user_session,
         COALESCE(BOOL_OR(COALESCE(event_type = 'cart', false)), false) AS has_cart,
         COALESCE(BOOL_OR(COALESCE(event_type = 'purchase', false)), false) AS has_purchase
  FROM enriched GROUP BY user_session
),
first_cart AS (
  SELECT user_session, date, root_category,
         ROW_NUMBER() OVER (PARTITION BY user_session ORDER BY event_ts, event_id) AS rn
  FROM enriched WHERE event_type = 'cart'
)"""
    )
    + """SELECT s.user_session, f.date, f.root_category, s.has_cart, s.has_purchase
FROM sess s LEFT JOIN first_cart f ON f.user_session = s.user_session AND f.rn = 1""",
    "cart_abandonment": _with(ABANDON) + "SELECT * FROM cart_abandonment",
    "session_products": _with(SP) + "SELECT session, product_id FROM sp",
    "product_session_counts": _with(SP)
    + "SELECT product_id, CAST(COUNT(*) AS BIGINT) AS session_count FROM sp GROUP BY product_id",
    "distinct_sessions": _with()
    + """SELECT CAST(COUNT(DISTINCT user_session)
       + COALESCE(MAX(CASE WHEN user_session IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_sessions
FROM enriched""",
    "co_occurrence": _with(SP)
    + """SELECT a.product_id AS product_a, b.product_id AS product_b,
       CAST(COUNT(*) AS BIGINT) AS co_occurrences
FROM sp a JOIN sp b ON a.session = b.session AND a.product_id < b.product_id
GROUP BY a.product_id, b.product_id""",
    "co_occurrence_blocked": _with(SP)
    + """SELECT a.product_id AS product_a, b.product_id AS product_b,
       CAST(COUNT(*) AS BIGINT) AS co_occurrences
FROM sp a JOIN sp b ON a.session = b.session AND a.product_id < b.product_id
GROUP BY a.product_id, b.product_id""",
    "product_affinity": _with(
        _affinity("enriched", "user_session", "WHERE event_type IN ('view', 'cart')", DEFAULT_TOP_PAIRS)
    ),
    "basket_affinity": "WITH baskets AS (SELECT l_orderkey AS basket_id, l_partkey AS product_id FROM lineitem),\n"
    + _affinity("baskets", "basket_id", "", DEFAULT_TOP_PAIRS),
    "affinity_session_sample": _with(
        f"""sampled AS (
  SELECT * FROM enriched
  WHERE substr(md5(COALESCE(user_session, '')), 1, 8) < '{session_threshold(SAMPLE_FRACTION)}'
)""",
        _affinity("sampled", "user_session", "WHERE event_type IN ('view', 'cart')", DEFAULT_TOP_PAIRS),
    ),
    "category_event_rows": _with() + "SELECT root_category AS category, event_type FROM enriched",
    "brand_price_rows": _with()
    + "SELECT brand, price FROM enriched WHERE event_type = 'purchase' AND brand IS NOT NULL",
    "category_events": _with() + CATEGORY_EVENTS,
    "brand_revenue": _with() + BRAND_REVENUE,
    "category_events_text": _with() + CATEGORY_EVENTS,
    "brand_revenue_text": _with() + BRAND_REVENUE,
    "data_range": _with() + "SELECT MIN(date) AS min_date, MAX(date) AS max_date FROM enriched",
    "last_30_days": _with(DAILY)
    + f"""SELECT date, total_events, unique_users, total_views, total_carts, total_purchases,
       {_money('total_revenue')} AS total_revenue, conversion_rate, avg_order_value
FROM daily_metrics
WHERE date >= (SELECT MAX(date) FROM daily_metrics) - INTERVAL 29 DAY""",
    "overview_kpis": _with(
        DAILY,
        f"""ov AS (
  SELECT CAST(COALESCE(SUM(total_events), 0) AS BIGINT) AS total_events,
         CAST(COALESCE(SUM(unique_users), 0) AS BIGINT) AS unique_users,
         CAST(COALESCE(SUM(total_views), 0) AS BIGINT) AS total_views,
         CAST(COALESCE(SUM(total_carts), 0) AS BIGINT) AS total_carts,
         CAST(COALESCE(SUM(total_purchases), 0) AS BIGINT) AS total_purchases,
         COALESCE(SUM(CAST(total_revenue AS DECIMAL(38,2))), 0) AS total_revenue
  FROM daily_metrics WHERE {_range()}
)""",
    )
    + f"""SELECT total_events, unique_users, total_views, total_carts, total_purchases,
       {_money('total_revenue')} AS total_revenue,
       {_ratio('total_purchases', 'unique_users')} AS conversion_rate,
       {_ratio('total_revenue', 'total_purchases')} AS avg_order_value
FROM ov""",
    "range_distinct_users": _with()
    + f"SELECT CAST(COUNT(DISTINCT user_id) AS BIGINT) AS distinct_users FROM enriched WHERE {_range()}",
    "overview_trend": _with(DAILY)
    + f"""SELECT date, total_views, total_carts, total_purchases, {_money('total_revenue')} AS total_revenue
FROM daily_metrics WHERE {_range()} ORDER BY date""",
    "funnel_range": _with(FUNNEL, FUNNEL_RANGE_ALL) + f"SELECT views, carts, purchases, {FR_RATES} FROM fr",
    "funnel_range_category": _with(
        FUNNEL,
        f"""fr AS (
  SELECT CAST(COALESCE(SUM(views), 0) AS BIGINT) AS views,
         CAST(COALESCE(SUM(carts), 0) AS BIGINT) AS carts,
         CAST(COALESCE(SUM(purchases), 0) AS BIGINT) AS purchases
  FROM funnel_stats WHERE {_range()} AND category = '{FUNNEL_CATEGORY}'
)""",
    )
    + f"SELECT views, carts, purchases, {FR_RATES} FROM fr",
    "funnel_stages": _with(FUNNEL, FUNNEL_RANGE_ALL, f"frr AS (SELECT views, carts, purchases, {FR_RATES} FROM fr)")
    + """SELECT 'Views' AS stage, 1 AS stage_order, views AS count, CAST(1.0 AS DOUBLE) AS rate FROM frr
UNION ALL SELECT 'Cart Adds', 2, carts, view_to_cart_rate FROM frr
UNION ALL SELECT 'Purchases', 3, purchases, overall_conversion FROM frr""",
    "funnel_categories": _with(FUNNEL) + "SELECT DISTINCT category FROM funnel_stats ORDER BY category",
    "abandonment_top": _with(ABANDON)
    + f"""SELECT category, abandoned_carts, ROUND(abandonment_rate, {RATE_DIGITS}) AS abandonment_rate,
       weighted_rate
FROM (
  SELECT category, CAST(SUM(abandoned_carts) AS BIGINT) AS abandoned_carts,
         AVG(abandonment_rate) AS abandonment_rate,
         {_ratio('SUM(abandoned_carts)', 'SUM(abandoned_carts + completed_purchases)')} AS weighted_rate
  FROM cart_abandonment WHERE {_range()} GROUP BY category
) t
ORDER BY t.abandonment_rate DESC, category LIMIT {TOP_ABANDONMENT}""",
    "products_by_revenue": _with(
        f"""prod AS (
  SELECT product_id, category_code AS category, brand, price, {MEASURES}
  FROM enriched GROUP BY product_id, category_code, brand, price
)"""
    )
    + f"""SELECT product_id, COALESCE(category, '') AS category, COALESCE(brand, '') AS brand, price,
       views, carts, purchases, CAST(revenue AS DOUBLE) AS revenue
FROM prod
ORDER BY prod.revenue DESC, product_id ASC NULLS FIRST, prod.category ASC NULLS FIRST,
         prod.brand ASC NULLS FIRST, price ASC NULLS FIRST
LIMIT {TOP_PRODUCTS}""",
    "products_by_revenue_range": _with(
        f"""prod AS (
  SELECT product_id, category_code AS category, brand, price, {MEASURES}
  FROM enriched WHERE {_range()} GROUP BY product_id, category_code, brand, price
)"""
    )
    + f"""SELECT product_id, COALESCE(category, '') AS category, COALESCE(brand, '') AS brand, price,
       views, carts, purchases, CAST(revenue AS DOUBLE) AS revenue
FROM prod
ORDER BY prod.revenue DESC, product_id ASC NULLS FIRST, prod.category ASC NULLS FIRST,
         prod.brand ASC NULLS FIRST, price ASC NULLS FIRST
LIMIT {TOP_PRODUCTS}""",
    "brands_by_revenue_range": _with(
        f"brs AS (SELECT brand, {MEASURES} FROM enriched WHERE brand IS NOT NULL AND {_range()} GROUP BY brand)"
    )
    + f"""SELECT COALESCE(brand, '') AS brand, views, carts, purchases, CAST(revenue AS DOUBLE) AS revenue
FROM brs ORDER BY brs.revenue DESC, brs.brand ASC NULLS FIRST LIMIT {TOP_BRANDS}""",
    "brands_by_revenue": _with(
        f"brs AS (SELECT brand, {MEASURES} FROM enriched WHERE brand IS NOT NULL GROUP BY brand)"
    )
    + f"""SELECT COALESCE(brand, '') AS brand, views, carts, purchases, CAST(revenue AS DOUBLE) AS revenue
FROM brs ORDER BY brs.revenue DESC, brs.brand ASC NULLS FIRST LIMIT {TOP_BRANDS}""",
    "categories_by_revenue": _with(
        f"cats AS (SELECT root_category AS category, {MEASURES} FROM enriched GROUP BY root_category)"
    )
    + """SELECT COALESCE(category, '') AS category, views, carts, purchases, CAST(revenue AS DOUBLE) AS revenue
FROM cats ORDER BY cats.revenue DESC, cats.category ASC NULLS FIRST""",
    "live_sessions": _with(LIVE) + "SELECT * FROM live",
    "live_sessions_stream": _with(LIVE) + "SELECT * FROM live",
    "live_sessions_expiring": _with(LIVE) + "SELECT * FROM live",
    "live_session_windows": _with(
        """gaps AS (
  SELECT *,
         CASE WHEN LAG(event_ts) OVER w IS NULL
                OR event_ts >= LAG(event_ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_win
  FROM enriched
  WINDOW w AS (PARTITION BY user_session ORDER BY event_ts, event_id)
),
numbered AS (
  SELECT *, SUM(new_win) OVER (PARTITION BY user_session ORDER BY event_ts, event_id
                                ROWS UNBOUNDED PRECEDING) AS win_no
  FROM gaps
),
ranked AS (
  SELECT *,
         ROW_NUMBER() OVER (PARTITION BY user_session, win_no ORDER BY event_ts, event_id) AS rn_first,
         ROW_NUMBER() OVER (PARTITION BY user_session, win_no ORDER BY event_ts DESC, event_id DESC) AS rn_last
  FROM numbered
)"""
    )
    + """SELECT user_session AS session_id,
       MIN(event_ts) AS window_start,
       MAX(event_ts) + INTERVAL 30 MINUTE AS window_end,
       MAX(CASE WHEN rn_first = 1 THEN user_id END) AS user_id,
       MAX(event_ts) AS last_event_time,
       CAST(COUNT(*) AS BIGINT) AS event_count,
       COALESCE(BOOL_OR(COALESCE(event_type = 'cart', false)), false) AS has_cart,
       COALESCE(BOOL_OR(COALESCE(event_type = 'purchase', false)), false) AS has_purchase,
       MAX(CASE WHEN rn_last = 1 THEN product_id END) AS last_product_id,
       MAX(CASE WHEN rn_last = 1 THEN category_code END) AS last_category
FROM ranked GROUP BY user_session, win_no""",
    "live_top": _with(LIVE)
    + f"""SELECT session_id, user_id, last_event_time, event_count, has_cart, has_purchase, last_product_id,
       COALESCE(last_category, '') AS last_category
FROM live ORDER BY last_event_time DESC NULLS LAST, session_id LIMIT {LIVE_TOP}""",
    "live_counters": _with(LIVE)
    + """SELECT CAST(COUNT(*) AS BIGINT) AS sessions,
       CAST(SUM(CASE WHEN has_cart THEN 1 ELSE 0 END) AS BIGINT) AS with_cart,
       CAST(SUM(CASE WHEN has_purchase THEN 1 ELSE 0 END) AS BIGINT) AS purchased
FROM live""",
    "live_counters_shown": _with(LIVE)
    + f"""SELECT CAST(COUNT(*) AS BIGINT) AS sessions,
       CAST(SUM(CASE WHEN has_cart THEN 1 ELSE 0 END) AS BIGINT) AS with_cart,
       CAST(SUM(CASE WHEN has_purchase THEN 1 ELSE 0 END) AS BIGINT) AS purchased
FROM (SELECT * FROM live ORDER BY last_event_time DESC NULLS LAST, session_id LIMIT {LIVE_SHOWN}) shown""",
    "event_json_roundtrip": _with() + ROUNDTRIP_COLUMNS,
    "csv_roundtrip": _with() + ROUNDTRIP_COLUMNS,
    "base_cube": _with()
    + """SELECT date, product_id, category_code, root_category, brand, price, event_type,
       CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(TRY_CAST(price AS DECIMAL(28,6))) AS DOUBLE) AS amount
FROM enriched GROUP BY date, product_id, category_code, root_category, brand, price, event_type""",
}

# the batch job's written tables hold what the direct forms give
for _name in ("daily_metrics", "top_products", "top_categories", "top_brands", "funnel_stats",
              "cart_abandonment", "product_affinity", "category_events", "brand_revenue"):
    SQL[f"batch_{_name}"] = SQL[_name]
SQL["batch_abandonment_top3"] = SQL["abandonment_top"].replace(f"LIMIT {TOP_ABANDONMENT}", "LIMIT 3")
SQL["event_defaults"] = _with() + """SELECT event_id, COALESCE(product_id, 0) AS product_id,
       COALESCE(category_code, '') AS category_code, COALESCE(brand, '') AS brand,
       COALESCE(price, 0.0) AS price, COALESCE(user_id, 0) AS user_id, COALESCE(user_session, '') AS user_session
FROM enriched"""

# the cube roll-ups compute the same tables as the direct forms
for _name in ("daily_metrics", "top_products", "top_categories", "top_brands", "funnel_stats",
              "category_events", "brand_revenue"):
    SQL[f"{_name}_cube"] = SQL[_name]

# other ways to the same tables: without frequent products, or batch by batch
SQL["product_affinity_pruned"] = SQL["product_affinity"]
SQL["basket_affinity_pruned"] = SQL["basket_affinity"]
SQL["attribute_affinity_pruned"] = """WITH baskets AS (
  SELECT l_orderkey AS basket_id, unnest([CAST(l_partkey AS BIGINT), -1000 - ascii(l_returnflag), -2000 - ascii(l_linestatus),
         -3000 - l_linenumber, -4000 - CAST(l_quantity AS BIGINT)]) AS product_id
  FROM lineitem
),
""" + _affinity("baskets", "basket_id", "", DEFAULT_TOP_PAIRS)
SQL["affinity_incremental"] = _with(_affinity("enriched", "user_id", "WHERE event_type IN ('view', 'cart')", DEFAULT_TOP_PAIRS))
for _name in ("daily_metrics", "funnel_stats", "cart_abandonment"):
    SQL[f"{_name}_incremental"] = SQL[_name]
SQL["range_distinct_users_stored"] = SQL["range_distinct_users"]
SQL["distinct_users_ranges"] = _with(
    "ranges(start_date, end_date) AS (VALUES " + ", ".join(f"(DATE '{a}', DATE '{b}')" for a, b in USER_RANGES) + ")"
) + """SELECT start_date, end_date, CAST(COUNT(DISTINCT user_id) AS BIGINT) AS distinct_users
FROM ranges LEFT JOIN enriched ON date >= start_date AND date <= end_date
GROUP BY start_date, end_date"""
SQL["numbered_users"] = _with() + """SELECT user_id AS "user", row_number() OVER (ORDER BY user_id) AS user_number
FROM (SELECT DISTINCT user_id FROM enriched WHERE user_id IS NOT NULL)"""
SQL["event_bottom_k"] = SQL["enriched_events"] + f" ORDER BY md5('{DEFAULT_SEED}:' || event_id), event_id LIMIT {SAMPLE_ROWS}"
SQL["category_events_ranked"] = _with(f"counts AS ({CATEGORY_EVENTS})") + """SELECT category, event_type, event_count,
       row_number() OVER (ORDER BY category, event_type) AS rank
FROM counts"""
SQL["csv_rejects"] = """SELECT rows_read, rows_read - rejected AS accepted, rejected, null_times,
       rows_read - rejected AS stored_accepted, rejected AS stored_rejected
FROM (
  SELECT COUNT(*) AS rows_read,
         COUNT(*) FILTER (event_id % 97 = 0 OR event_id % 89 = 0) AS rejected,
         COUNT(*) FILTER (event_id % 83 = 0 AND event_id % 97 <> 0 AND event_id % 89 <> 0) AS null_times
  FROM events
) counted"""
