"""SQL twins of the registered queries, for an independent engine.

The statements share the common table expressions below; money is compared as
double, averages are rounded with integer arithmetic.
"""


_CTES = {
    # events in the raw model, typed
    "curated": """
        SELECT CAST(e.event_id AS VARCHAR) AS event_id,
               CAST(e.user_id AS VARCHAR) AS user_id,
               e.props->>'k' AS product_id,
               CASE WHEN e.event_type = 'signup' THEN 'cart_add' ELSE e.event_type END AS event_type,
               CASE WHEN e.event_type = 'purchase' THEN CAST(e.value AS DECIMAL(10,2)) END AS price,
               epoch_us(e.ts) // 1000 AS ms,
               CAST(e.ts AS DATE) AS day,
               CAST(hour(e.ts) AS BIGINT) AS hour,
               p.p_type AS category, p.p_brand AS brand,
               CASE e.event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END
                   AS device_type,
               concat_ws('.', 10 + e.user_id % 4, (e.user_id // 256) % 256, e.user_id % 256, 1)
                   AS ip_address,
               CASE e.user_id % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' WHEN 2 THEN 'IN'
                    ELSE 'Unknown' END AS country,
               CASE e.user_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C'
                    ELSE 'Unknown' END AS city
        FROM events e LEFT JOIN part p ON p.p_partkey = CAST(e.props->>'k' AS BIGINT)""",
    "flagged": """
        SELECT *, CASE WHEN ms - lag(ms) OVER w <= 1800000 THEN 0 ELSE 1 END AS starts
        FROM curated WINDOW w AS (PARTITION BY user_id ORDER BY ms)""",
    "numbered": """
        SELECT *, CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY ms) AS BIGINT) AS session_seq
        FROM flagged""",
    "sessioned": """
        SELECT *, min(ms) OVER (PARTITION BY user_id, session_seq) AS start_ms,
               user_id || '-' || CAST(min(ms) OVER (PARTITION BY user_id, session_seq) AS VARCHAR)
                   AS session_id
        FROM numbered""",
    "sales": """
        SELECT session_id, user_id, day,
               sum(price) AS revenue, CAST(count(*) AS BIGINT) AS items_purchased,
               array_to_string(list_sort(list_distinct(list(category))), ',') AS categories_purchased,
               arg_min(device_type, (ms, event_id)) AS device_type
        FROM sessioned WHERE event_type = 'purchase'
        GROUP BY session_id, user_id, day""",
    "metrics": """
        SELECT s.user_id,
               CAST(date_diff('day', max(day), DATE '2024-01-31') AS BIGINT) AS recency_days,
               CAST(count(DISTINCT session_id) AS BIGINT) AS frequency,
               CAST(sum(revenue) * 100 AS BIGINT) AS cents,
               arg_min(device_type, (day, session_id)) AS preferred_device,
               min(day) AS first_purchase, max(day) AS last_purchase,
               any_value(c.categories) AS categories,
               any_value(c.n) AS category_diversity
        FROM sales s JOIN (
            SELECT user_id, array_to_string(list_sort(list_distinct(list(category))), ',') AS categories,
                   CAST(count(DISTINCT category) AS BIGINT) AS n
            FROM curated WHERE event_type = 'purchase' GROUP BY user_id) c ON c.user_id = s.user_id
        GROUP BY s.user_id""",
    # order lines as sales facts
    "facts": """
        SELECT CAST(l_orderkey AS VARCHAR) AS sale_id,
               CAST(o_custkey AS VARCHAR) AS user_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(o_orderdate AS DATE) AS date_key,
               CAST(l_quantity AS BIGINT) AS quantity,
               (2 * CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)
                   + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT)) AS unit_cents,
               CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                   * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2)) * 100 AS BIGINT)
                   AS cents,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
                   AS DECIMAL(10,2)) AS discount,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))
                   AS DECIMAL(10,2)) AS tax
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "daily": """
        SELECT date_key, p_type AS category,
               CAST(sum(cents) AS BIGINT) AS cents, CAST(count(*) AS BIGINT) AS n,
               CAST(count(DISTINCT sale_id) AS BIGINT) AS total_orders,
               CAST(count(DISTINCT user_id) AS BIGINT) AS unique_customers
        FROM facts JOIN part ON CAST(p_partkey AS VARCHAR) = product_id
        GROUP BY date_key, p_type""",
    "firsts": """
        SELECT user_id, date_trunc('month', min(date_key)) AS cohort FROM facts GROUP BY user_id""",
    "cohort": """
        SELECT CAST(cohort AS DATE) AS cohort_month,
               CAST(date_diff('month', cohort, date_key) AS BIGINT) AS period,
               CAST(count(DISTINCT f.user_id) AS BIGINT) AS active,
               CAST(sum(cents) AS BIGINT) AS cents
        FROM firsts JOIN facts f ON f.user_id = firsts.user_id GROUP BY 1, 2""",
    "retained": """
        SELECT *, first_value(active) OVER (PARTITION BY cohort_month ORDER BY period) AS initial
        FROM cohort""",
    "order_metrics": """
        SELECT user_id,
               CAST(date_diff('day', max(date_key), DATE '2001-08-01') AS BIGINT) AS recency_days,
               CAST(count(DISTINCT sale_id) AS BIGINT) AS frequency,
               CAST(sum(cents) AS BIGINT) AS cents,
               min(date_key) AS first_purchase, max(date_key) AS last_purchase,
               CAST((year(max(date_key)) - year(min(date_key))) * 12
                   + month(max(date_key)) - month(min(date_key)) + 1 AS BIGINT) AS months
        FROM facts GROUP BY user_id""",
    "category_day": """
        SELECT day, category, CAST(count(*) AS BIGINT) AS event_count,
               CAST(count(DISTINCT user_id) AS BIGINT) AS unique_users,
               CAST(coalesce(sum(price), 0) * 100 AS BIGINT) AS cents,
               CAST(count(price) AS BIGINT) AS n
        FROM curated GROUP BY day, category""",
}

_NEEDS = {
    "flagged": ["curated"],
    "numbered": ["flagged"],
    "sessioned": ["numbered"],
    "sales": ["sessioned"],
    "metrics": ["sales"],
    "daily": ["facts"],
    "firsts": ["facts"],
    "cohort": ["firsts"],
    "retained": ["cohort"],
    "order_metrics": ["facts"],
    "category_day": ["curated"],
    "scored": ["metrics"],
    "order_scored": ["order_metrics"],
    "order_customers": ["order_scored"],
}


def _scored(source: str, best: str) -> str:
    up, down = ("", "DESC") if best == "high" else ("DESC", "")
    return f"""
        SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days {down}, user_id) AS BIGINT) AS r,
               CAST(ntile(5) OVER (ORDER BY frequency {up}, user_id) AS BIGINT) AS f,
               CAST(ntile(5) OVER (ORDER BY cents {up}, user_id) AS BIGINT) AS m
        FROM {source}"""


_CTES["scored"] = _scored("metrics", "high")
_CTES["order_scored"] = _scored("order_metrics", "high")

_RFM_SEGMENT = """CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions'
    WHEN f >= 4 THEN 'Loyal'
    WHEN r <= 2 AND (f >= 3 OR m >= 3) THEN 'At Risk'
    WHEN r >= 4 AND f <= 2 THEN 'New'
    WHEN r = 1 AND f <= 2 AND m <= 2 THEN 'Lost'
    ELSE 'Regular' END"""
_CUSTOMER_SEGMENT = """CASE WHEN recency_days > 180 THEN 'Churned'
    WHEN m = 5 AND f >= 4 THEN 'VIP'
    WHEN frequency = 1 THEN 'New'
    ELSE 'Returning' END"""


def _half_up(total: str, count: str, scale: int = 100) -> str:
    """Integer quotient rounded half up, as double; ``scale`` is the unit of ``total``."""
    return f"CAST((2 * {total} + {count}) // (2 * {count}) AS DOUBLE) / {scale}"


_MONTHS = (
    "(year(last_purchase) - year(first_purchase)) * 12"
    " + month(last_purchase) - month(first_purchase) + 1"
)

_CTES["order_customers"] = f"""
        SELECT CAST(c_custkey AS VARCHAR) AS user_id,
               coalesce({_CUSTOMER_SEGMENT.replace("ELSE 'Returning'", "WHEN frequency > 1 THEN 'Returning'")}, 'New')
                   AS customer_segment,
               CASE WHEN r IS NOT NULL THEN {_RFM_SEGMENT} END AS rfm_segment,
               {_half_up("cents * 12", "months")} AS ltv_12m
        FROM customer LEFT JOIN order_scored ON user_id = CAST(c_custkey AS VARCHAR)"""


def _with(name: str, body: str, overrides: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the expressions ``name`` needs, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for need in _NEEDS.get(n, []):
            visit(need)
        if n not in order:
            order.append(n)

    for n in name.split():
        visit(n)
    ctes = {**_CTES, **(overrides or {})}
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in order) + "\n" + body


_CLEAN = _with(
    "curated",
    """SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS client_session_id, product_id, event_type,
              CAST(price AS DOUBLE) AS price, ms * 1000 AS event_ts, category, brand, device_type,
              ip_address, CAST(day AS VARCHAR) AS event_date, hour FROM curated""",
)
_SESSIONIZED = _with(
    "sessioned",
    """SELECT event_id, user_id, event_type, ms * 1000 AS event_ts, session_seq,
              start_ms * 1000 AS session_start, session_id FROM sessioned""",
)
_SALES = _with(
    "sales",
    """SELECT session_id, user_id, CAST(revenue AS DOUBLE) AS total_revenue, items_purchased,
              categories_purchased, device_type, CAST(day AS VARCHAR) AS event_date FROM sales""",
)
_ENRICHED = _with(
    "curated",
    """SELECT md5(user_id || CAST(ms AS VARCHAR)) AS event_id, user_id, product_id, event_type,
              ms AS timestamp, category, brand, device_type, ip_address, country, city,
              'kinesis_stream' AS source FROM curated""",
)
#: two features: the normal equations by Cramer's rule
_MOMENTS = """
    , spent AS (
        SELECT user_id, CAST(coalesce(sum(cents) FILTER (date_key <= DATE '1998-01-01'), 0) AS DOUBLE) / 100 AS x1,
               CAST(count(DISTINCT sale_id) FILTER (date_key <= DATE '1998-01-01') AS DOUBLE) AS x2,
               CAST(coalesce(sum(cents) FILTER (date_key > DATE '1998-01-01'), 0) AS DOUBLE) / 100 AS y
        FROM facts GROUP BY user_id),
    means AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, CAST(count(*) AS BIGINT) AS n FROM spent),
    products AS (
        SELECT sum((x1 - m1) * (x1 - m1)) AS s11, sum((x1 - m1) * (x2 - m2)) AS s12, sum((x2 - m2) * (x2 - m2)) AS s22,
               sum((x1 - m1) * (y - my)) AS s1y, sum((x2 - m2) * (y - my)) AS s2y, sum((y - my) * (y - my)) AS syy
        FROM spent, means),
    fitted AS (
        SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
               (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2
        FROM products, means)
"""
_DIM_SESSION = """SELECT session_id, user_id, min(ms) * 1000 AS session_start,
           max(ms) * 1000 AS session_end, (max(ms) - min(ms)) // 1000 AS duration_secs,
           CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS page_views,
           arg_min(device_type, (ms, event_id)) AS device_type
    FROM sessioned GROUP BY session_id, user_id"""

_DEDUP = _with(
    "curated",
    """SELECT event_id, event_type, product_id, user_id, ms * 1000 AS event_ts,
              CAST(price AS DOUBLE) AS price FROM curated
       QUALIFY row_number() OVER (PARTITION BY event_id, event_type, product_id ORDER BY ms) = 1""",
)
_DAILY = f"""SELECT CAST(date_key AS VARCHAR) AS date_key, category,
    CAST(cents AS DOUBLE) / 100 AS total_revenue, {{orders}} AS total_orders, unique_customers,
    {_half_up("cents", "n")} AS avg_order_value FROM daily"""
_COHORT = f"""SELECT CAST(cohort_month AS VARCHAR) AS cohort_month, period,
    {{active}} AS active_customers, CAST(cents AS DOUBLE) / 100 AS revenue,
    {_half_up("active * 10000", "initial", 10000)} AS retention_rate FROM retained"""
_CATEGORY_DAY = f"""SELECT CAST(day AS VARCHAR) AS event_date, category, {{events}} AS event_count,
    unique_users, CAST(cents AS DOUBLE) / 100 AS revenue,
    CASE WHEN n > 0 THEN {_half_up("cents", "greatest(n, 1)")} END AS avg_order_value
    FROM category_day"""
_SCORES = """SELECT user_id, r AS recency_score, f AS frequency_score, m AS monetary_score,
    r + f + m AS rfm_score FROM """
_REVENUE = """SELECT CAST(year(date_key) AS BIGINT) AS year, CAST(month(date_key) AS BIGINT) AS month,
    p_type AS category, CAST(sum(cents) AS DOUBLE) / 100 AS revenue,
    CAST(count(DISTINCT user_id) AS BIGINT) AS unique_buyers
    FROM facts JOIN part ON CAST(p_partkey AS VARCHAR) = product_id {where}
    GROUP BY 1, 2, 3 ORDER BY 1, 2, revenue DESC"""


def _check(table: str, kind: str, column: str, count: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{kind}' AS check_kind, '{column}' AS column_name, "
        f"CAST(({count}) AS BIGINT) AS violations"
    )


_INTEGRITY = " UNION ALL ".join(
    [
        _check("fact_sales", "primary_key", "sale_id",
               "SELECT count(*) FROM (SELECT 1 FROM facts GROUP BY sale_id HAVING count(*) > 1)"),
        _check("dim_customer", "primary_key", "user_id",
               "SELECT count(*) FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)"),
        _check("dim_product", "primary_key", "product_id",
               "SELECT count(*) FROM (SELECT 1 FROM part GROUP BY p_partkey HAVING count(*) > 1)"),
        _check("dim_date", "primary_key", "date_key", "SELECT 0"),
        _check("fact_sales", "foreign_key", "user_id",
               "SELECT count(*) FROM facts WHERE user_id NOT IN "
               "(SELECT CAST(c_custkey AS VARCHAR) FROM customer)"),
        _check("fact_sales", "foreign_key", "product_id",
               "SELECT count(*) FROM facts WHERE product_id NOT IN "
               "(SELECT CAST(p_partkey AS VARCHAR) FROM part)"),
        _check("fact_sales", "foreign_key", "date_key", "SELECT 0"),
        _check("fact_sales", "not_null", "session_id", "SELECT count(*) FROM facts WHERE sale_id IS NULL"),
        _check("fact_sales", "not_null", "user_id", "SELECT count(*) FROM facts WHERE user_id IS NULL"),
        _check("fact_sales", "not_null", "product_id",
               "SELECT count(*) FROM facts WHERE product_id IS NULL"),
        _check("fact_sales", "not_null", "date_key", "SELECT count(*) FROM facts WHERE date_key IS NULL"),
        _check("fact_sales", "not_null", "unit_price",
               "SELECT count(*) FROM facts WHERE unit_cents IS NULL"),
        _check("fact_sales", "not_null", "total_amount", "SELECT count(*) FROM facts WHERE cents IS NULL"),
        _check("fact_sales", "not_null", "payment_method", "SELECT count(*) FROM facts"),
    ]
)

_CUSTOMER_360_LITERAL = """
    SELECT c.user_id, c.customer_segment, c.ltv_12m, c.rfm_segment,
           CAST(count(DISTINCT fs.sale_id) AS BIGINT) AS total_orders,
           CAST(sum(fs.cents) AS DOUBLE) / 100 AS lifetime_spend,
           CAST(max(fs.date_key) AS VARCHAR) AS last_purchase_date,
           CAST(count(DISTINCT fe.event_id) AS BIGINT) AS total_events
    FROM order_customers c
    LEFT JOIN facts fs ON c.user_id = fs.user_id
    LEFT JOIN curated fe ON c.user_id = fe.user_id
    GROUP BY ALL"""
_CUSTOMER_360 = """
    SELECT c.user_id, c.customer_segment, c.ltv_12m, c.rfm_segment,
           coalesce(s.orders, 0) AS total_orders,
           CAST(s.cents AS DOUBLE) / 100 AS lifetime_spend,
           CAST(s.last_day AS VARCHAR) AS last_purchase_date,
           coalesce(e.n, 0) AS total_events
    FROM order_customers c
    LEFT JOIN (SELECT user_id, CAST(count(DISTINCT sale_id) AS BIGINT) AS orders,
                      sum(cents) AS cents, max(date_key) AS last_day
               FROM facts GROUP BY user_id) s ON s.user_id = c.user_id
    LEFT JOIN (SELECT user_id, CAST(count(DISTINCT event_id) AS BIGINT) AS n
               FROM curated GROUP BY user_id) e ON e.user_id = c.user_id"""


def statements() -> dict[str, str]:
    low = {"scored": _scored("metrics", "low")}
    return {
        "clean_events": _CLEAN,
        "decode_events": _CLEAN,
        "json_scan": _CLEAN,
        "mapped_events": _with(
            "curated",
            """SELECT user_id, product_id, event_type, CAST(price AS DOUBLE) AS price,
                      (ms // 1000) * 1000000 AS event_ts, category, brand, hour FROM curated""",
        ),
        "dedup_events": _DEDUP,
        "enrich_events": _ENRICHED,
        "sessionize_events": _SESSIONIZED,
        "sessionize_incremental": _SESSIONIZED,
        "session_windows": _with(
            "sessioned",
            """SELECT user_id, min(ms) * 1000 AS session_start, max(ms) * 1000 AS session_end,
                      CAST(count(*) AS BIGINT) AS events
               FROM sessioned GROUP BY user_id, session_seq""",
        ),
        "session_sales": _SALES,
        "curated_sales_table": _SALES,
        "catalog_sales_scan": _SALES,
        "merged_schema_sales": _with(
            "sales",
            """SELECT session_id, user_id, CAST(revenue AS DOUBLE) AS total_revenue,
                      CASE WHEN revenue >= 50 THEN 'big' END AS tier FROM sales""",
        ),
        "dim_date": """
            SELECT CAST(d AS VARCHAR) AS date_key, CAST(year(d) AS BIGINT) AS year,
                   CAST(quarter(d) AS BIGINT) AS quarter, CAST(month(d) AS BIGINT) AS month,
                   CAST(week(d) AS BIGINT) AS week, CAST(day(d) AS BIGINT) AS day,
                   dayname(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
                   false AS is_holiday
            FROM (SELECT CAST(unnest(generate_series(
                      (SELECT CAST(min(o_orderdate) AS DATE) FROM orders),
                      (SELECT CAST(max(o_orderdate) AS DATE) FROM orders),
                      INTERVAL 1 DAY)) AS DATE) AS d)""",
        "dim_product": """
            SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
                   p_type AS category, p_brand AS brand,
                   CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
                   true AS is_active FROM part""",
        "dim_product_events": _with(
            "curated",
            """SELECT product_id, arg_max(category, (ms, event_id)) AS category,
                      arg_max(brand, (ms, event_id)) AS brand,
                      CAST(arg_max(price, (ms, event_id)) FILTER (WHERE price IS NOT NULL) AS DOUBLE)
                          AS price,
                      true AS is_active, CAST(min(day) AS VARCHAR) AS created_date
               FROM curated WHERE product_id IS NOT NULL GROUP BY product_id""",
        ),
        "product_margin": f"""
            SELECT product_id, CAST(price AS DOUBLE) / 100 AS price, CAST(cost AS DOUBLE) / 100 AS cost,
                   {_half_up("(price - cost) * 10000", "price")} AS margin_pct
            FROM (SELECT *, (2 * price * (p_size + 20) + 100) // 200 AS cost
                  FROM (SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_size,
                               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 100 AS BIGINT) AS price
                        FROM part))""",
        "dim_session": _with("sessioned", _DIM_SESSION),
        "user_activity": _with(
            "curated",
            """SELECT user_id, CAST(min(day) AS VARCHAR) AS first_seen,
                      CAST(max(day) AS VARCHAR) AS last_seen, min(country) AS country,
                      min(city) AS city FROM curated GROUP BY user_id""",
        ),
        "dim_customer": _with(
            "scored",
            f"""SELECT a.user_id, CAST(a.first_seen AS VARCHAR) AS first_seen,
                       CAST(a.last_seen AS VARCHAR) AS last_seen,
                       CASE WHEN s.user_id IS NULL THEN 'New' ELSE {_CUSTOMER_SEGMENT} END
                           AS customer_segment,
                       preferred_device, country, city,
                       {_half_up("cents * 12", f"({_MONTHS})")} AS ltv_12m,
                       r AS recency_score, f AS frequency_score, m AS monetary_score,
                       CASE WHEN s.user_id IS NOT NULL THEN {_RFM_SEGMENT} END AS rfm_segment
                FROM (SELECT user_id, min(day) AS first_seen, max(day) AS last_seen,
                             min(country) AS country, min(city) AS city
                      FROM curated GROUP BY user_id) a
                LEFT JOIN scored s ON s.user_id = a.user_id""",
        ),
        "fact_sales": _with(
            "sessioned",
            """SELECT event_id AS sale_id, session_id, user_id, product_id,
                      CAST(day AS VARCHAR) AS date_key, hour, CAST(1 AS BIGINT) AS quantity,
                      CAST(price AS DOUBLE) AS unit_price, CAST(price AS DOUBLE) AS total_amount,
                      CAST(0 AS DOUBLE) AS discount_amount
               FROM sessioned WHERE event_type = 'purchase'""",
        ),
        "fact_sales_orders": _with(
            "facts",
            """SELECT sale_id, sale_id AS session_id, user_id, product_id,
                      CAST(date_key AS VARCHAR) AS date_key, quantity,
                      CAST(unit_cents AS DOUBLE) / 100 AS unit_price,
                      CAST(cents AS DOUBLE) / 100 AS total_amount,
                      CAST(discount AS DOUBLE) AS discount_amount, CAST(tax AS DOUBLE) AS tax_amount
               FROM facts""",
        ),
        "fact_user_events": _with(
            "sessioned",
            """SELECT event_id, session_id, user_id, product_id, CAST(day AS VARCHAR) AS date_key,
                      ms * 1000 AS event_timestamp, event_type, category, brand, device_type
               FROM sessioned""",
        ),
        "daily_sales": _with("daily", _DAILY.format(orders="total_orders")),
        "daily_sales_refresh": _with(
            "daily",
            _DAILY.format(
                orders="CASE WHEN date_key >= DATE '2001-07-30' THEN total_orders "
                "ELSE total_orders + 1000 END"
            ),
        ),
        "cohort_retention": _with("retained", _COHORT.format(active="active")),
        "cohort_state": _with("retained", _COHORT.format(active="active")),
        "daily_sales_by_differences": _with("daily", _DAILY.format(orders="total_orders")),
        "category_metrics_by_differences": _with("category_day", _CATEGORY_DAY.format(events="event_count")),
        "cohort_refresh": _with(
            "retained",
            _COHORT.format(
                active="CASE WHEN cohort_month >= DATE '1995-09-01' THEN active "
                "ELSE active + 1000 END"
            ),
        ),
        "customer_360": _with("curated order_customers", _CUSTOMER_360),
        "customer_360_literal": _with("curated order_customers", _CUSTOMER_360_LITERAL),
        "product_performance": _with(
            "facts",
            f"""SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
                       p_type AS category, p_brand AS brand, s.units_sold,
                       CAST(s.cents AS DOUBLE) / 100 AS total_revenue,
                       coalesce(s.buyers, 0) AS unique_buyers,
                       {_half_up("s.unit_cents", "s.n")} AS avg_selling_price
                FROM part LEFT JOIN (
                    SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold,
                           CAST(sum(cents) AS BIGINT) AS cents,
                           CAST(sum(unit_cents) AS BIGINT) AS unit_cents,
                           CAST(count(*) AS BIGINT) AS n,
                           CAST(count(DISTINCT user_id) AS BIGINT) AS buyers
                    FROM facts GROUP BY product_id) s ON s.product_id = CAST(p_partkey AS VARCHAR)""",
        ),
        "daily_category_metrics": _with("category_day", _CATEGORY_DAY.format(events="event_count")),
        "category_metrics_refresh": _with(
            "category_day",
            _CATEGORY_DAY.format(
                events="CASE WHEN day >= DATE '2024-01-20' THEN event_count "
                "ELSE event_count + 1000 END"
            ),
        ),
        "revenue_by_category_month": _with("facts", _REVENUE.format(where="")),
        "revenue_by_category_month_of_year": _with(
            "facts", _REVENUE.format(where="WHERE year(date_key) = 1998")
        ),
        "revenue_by_category_month_pruned": _with(
            "facts", _REVENUE.format(where="WHERE year(date_key) = 1998")
        ),
        "ltv_moments": _with(
            "facts",
            _MOMENTS + """
            SELECT name, printf('%.6e', v) AS value, n AS customers
            FROM fitted, (VALUES ('monetary', 1), ('frequency', 2), ('intercept', 3), ('r2', 4)) t(name, k),
                 LATERAL (SELECT CASE k WHEN 1 THEN b1 WHEN 2 THEN b2 WHEN 3 THEN my - b1 * m1 - b2 * m2
                                 ELSE (b1 * s1y + b2 * s2y) / syy END AS v)""",
        ),
        "ltv_moment_scores": _with(
            "facts",
            _MOMENTS + """
            SELECT user_id, printf('%.6e', my + b1 * (x1 - m1) + b2 * (x2 - m2)) AS prediction
            FROM spent, fitted""",
        ),
        "customer_activity": _with(
            "curated",
            """SELECT user_id, CAST(count(*) AS BIGINT) AS frequency,
                      CAST(coalesce(sum(price), 0) AS DOUBLE) AS monetary,
                      CAST(CAST(coalesce(sum(price), 0) * 1000 AS BIGINT) * 3 // 2 AS DOUBLE) / 1000
                          AS predicted_ltv
               FROM curated GROUP BY user_id""",
        ),
        "integrity_report": _with("facts", _INTEGRITY),
        "constraints_on_write": _with(
            "facts",
            """, broken AS (
                SELECT CAST(sale_id AS BIGINT) % 11 = 3 AS orphan, CAST(sale_id AS BIGINT) % 13 = 5 AS unpriced FROM facts),
            checks(check_kind, column_name) AS (VALUES
                ('not_null', 'sale_id'), ('not_null', 'session_id'), ('not_null', 'user_id'), ('not_null', 'product_id'),
                ('not_null', 'date_key'), ('not_null', 'unit_price'), ('not_null', 'total_amount'), ('foreign_key', 'user_id'),
                ('foreign_key', 'product_id'), ('foreign_key', 'date_key'), ('refused', ''), ('rows', ''), ('quarantined', ''))
            SELECT 'fact_sales' AS table_name, check_kind, column_name, CAST(CASE
                WHEN column_name = 'unit_price' THEN (SELECT count(*) FROM broken WHERE unpriced)
                WHEN check_kind = 'foreign_key' AND column_name = 'user_id' THEN (SELECT count(*) FROM broken WHERE orphan)
                WHEN check_kind IN ('refused', 'quarantined') THEN (SELECT count(*) FROM broken WHERE unpriced OR orphan)
                WHEN check_kind = 'rows' THEN (SELECT count(*) FROM broken WHERE NOT unpriced AND NOT orphan)
                ELSE 0 END AS BIGINT) AS violations
            FROM checks""",
        ),
        "rfm_metrics": _with(
            "metrics",
            f"""SELECT user_id, recency_days, frequency, CAST(cents AS DOUBLE) / 100 AS monetary,
                       categories, preferred_device, CAST(first_purchase AS VARCHAR) AS first_purchase,
                       CAST(last_purchase AS VARCHAR) AS last_purchase, category_diversity,
                       {_half_up("cents", "frequency")} AS aov
                FROM metrics""",
        ),
        "rfm_scores_high": _with("scored", _SCORES + "scored"),
        "rfm_scores_low": _with("scored", _SCORES + "scored", low),
        "rfm_scores_orders": _with("order_scored", _SCORES + "order_scored"),
        "rfm_segments": _with(
            "scored",
            f"""SELECT user_id, r + f + m AS rfm_score, {_RFM_SEGMENT} AS rfm_segment,
                       {_CUSTOMER_SEGMENT} AS customer_segment FROM scored""",
        ),
        "ltv_formula": _with(
            "order_metrics",
            f"""SELECT user_id, {_half_up("cents", "frequency")} AS aov, months AS active_months,
                       {_half_up("cents * 12", "months")} AS ltv_12m FROM order_metrics""",
        ),
        "ltv_same_period": _with(
            "scored",
            """SELECT user_id, recency_days, frequency, CAST(cents AS DOUBLE) / 100 AS monetary,
                      r + f + m AS rfm_score, CAST(cents AS DOUBLE) / 100 AS predicted_ltv_12m,
                      preferred_device FROM scored""",
            low,
        ),
        "interactions": _with(
            "curated",
            """SELECT user_id, product_id,
                      avg(CASE event_type WHEN 'purchase' THEN 5.0 WHEN 'cart_add' THEN 3.0 ELSE 1.0
                          END) AS rating
               FROM curated WHERE event_type IN ('view', 'cart_add', 'purchase')
               GROUP BY user_id, product_id""",
        ),
        "embedding_similarity_topk": """
            WITH pairs AS (
                SELECT a.vec_id AS item_id, b.vec_id AS similar_id,
                       list_cosine_similarity(CAST(a.embedding AS DOUBLE[]),
                                              CAST(b.embedding AS DOUBLE[])) AS s
                FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY s DESC, similar_id)
                       AS BIGINT) AS rank, similar_id, round(s, 6) AS similarity
            FROM pairs
            QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY s DESC, similar_id) <= 10""",
        "recommendations_table": _with(
            "curated",
            """SELECT user_id, n AS recommended, n AS products, true AS not_negative,
                      CAST(0 AS BIGINT) AS not_rated
               FROM (SELECT user_id, least(10, (SELECT count(DISTINCT product_id) FROM curated
                            WHERE event_type IN ('view', 'cart_add', 'purchase'))) AS n
                     FROM curated WHERE event_type IN ('view', 'cart_add', 'purchase')
                     GROUP BY user_id)""",
        ),
        "customer_ltv_table": _with(
            "scored",
            """SELECT user_id, recency_days, frequency, CAST(cents AS DOUBLE) / 100 AS monetary,
                      r + f + m AS rfm_score, CAST(cents AS DOUBLE) / 100 AS predicted_ltv_12m,
                      preferred_device FROM scored""",
            low,
        ),
        "als_optimality_check": _with(
            "curated",
            """SELECT user_id, CAST(count(DISTINCT product_id) AS BIGINT) AS ratings, true AS best
               FROM curated WHERE event_type IN ('view', 'cart_add', 'purchase') GROUP BY user_id""",
        ),
        "item_vectors_table": _with(
            "curated",
            """SELECT DISTINCT product_id, CAST(10 AS BIGINT) AS length, true AS finite, true AS same
               FROM curated WHERE event_type IN ('view', 'cart_add', 'purchase')""",
        ),
        "als_recommendations_check": _with(
            "curated",
            """SELECT user_id, n AS recommended, n AS products, true AS not_negative,
                      CAST(0 AS BIGINT) AS not_rated
               FROM (SELECT user_id, least(10, (SELECT count(DISTINCT product_id) FROM curated
                            WHERE event_type IN ('view', 'cart_add', 'purchase'))) AS n
                     FROM curated WHERE event_type IN ('view', 'cart_add', 'purchase')
                     GROUP BY user_id)""",
        ),
        "als_unseen_check": _with(
            "curated",
            """SELECT user_id, n AS recommended, n AS products, true AS not_negative,
                      CAST(0 AS BIGINT) AS not_rated, CAST(0 AS BIGINT) AS seen
               FROM (SELECT user_id, least(10, (SELECT count(DISTINCT product_id) FROM curated
                            WHERE event_type IN ('view', 'cart_add', 'purchase'))
                            - count(DISTINCT product_id)) AS n
                     FROM curated WHERE event_type IN ('view', 'cart_add', 'purchase')
                     GROUP BY user_id)
               WHERE n > 0""",
        ),
        "item_vectors_check": _with(
            "curated",
            """SELECT DISTINCT product_id, CAST(10 AS BIGINT) AS length, true AS finite
               FROM curated WHERE event_type IN ('view', 'cart_add', 'purchase')""",
        ),
        "item_similarity_check": _with(
            "curated",
            """SELECT product_id AS item_id, least(10, (count(*) OVER ()) - 1) AS neighbours,
                      CAST(1 AS BIGINT) AS first_rank, neighbours AS last_rank, true AS falling,
                      false AS itself
               FROM (SELECT DISTINCT product_id FROM curated
                     WHERE event_type IN ('view', 'cart_add', 'purchase'))""",
        ),
        "ltv_regression_check": _with(
            "facts",
            """SELECT feature, true AS orthogonal, true AS finite,
                      (SELECT count(DISTINCT user_id) FROM facts WHERE date_key <= DATE '2000-08-01')
                          AS customers
               FROM unnest(['recency_days', 'frequency', 'monetary', 'rfm_score', 'aov', 'intercept'])
                   AS f(feature)""",
        ),
        "discover_events": _with(
            "curated",
            """SELECT event_id, CAST(price AS DOUBLE) AS price, CAST(day AS VARCHAR) AS day,
                      CASE WHEN CAST(event_id AS BIGINT) % 331 = 7 THEN 'c' || event_id END AS coupon
               FROM curated""",
        ),
        "enrich_keeps_fields": _with(
            "curated",
            """SELECT user_id, ms AS timestamp,
                      CASE WHEN CAST(event_id AS BIGINT) % 10 = 3 THEN 'c' || event_id END AS coupon
               FROM curated WHERE CAST(event_id AS BIGINT) % 100 <> 5""",
        ),
        "rejected_lines": _with(
            "curated",
            """SELECT substr('{"event_id":"' || event_id || '","user_id":"' || user_id
                             || '","product_id":"' || product_id || '","event_type":"' || event_type,
                             1, 40) AS line,
                      'unreadable' AS reason, count(*) AS n
               FROM curated WHERE CAST(event_id AS BIGINT) % 100 = 5 GROUP BY line""",
        ),
        "late_events": _with(
            "sessioned",
            """SELECT event_id, user_id,
                      min(ms) OVER (PARTITION BY user_id, session_seq) * 1000 AS session_start
               FROM sessioned""",
        ),
        "late_sessions": _with("sessioned", _DIM_SESSION),
        "late_events_all": _with(
            "sessioned",
            "SELECT event_id, user_id, session_seq, session_id FROM sessioned",
        ),
        "stream_record_count": "SELECT count(*) AS records, count(*) AS delivered FROM events",
        "stream_enrich": _ENRICHED,
        "stream_raw_delivery": _with(
            "curated",
            """SELECT md5(user_id || CAST(ms AS VARCHAR)) AS event_id, user_id, event_type, product_id,
                      CAST(price AS DOUBLE) AS price, ms * 1000 AS event_ts, country, city
               FROM curated""",
        ),
        "stream_delivery_exactly_once": _with(
            "curated",
            """SELECT md5(user_id || CAST(ms AS VARCHAR)) AS event_id, user_id, event_type, product_id,
                      CAST(price AS DOUBLE) AS price, ms * 1000 AS event_ts, country, city
               FROM curated""",
        ),
        "stream_dedup": _DEDUP,
        "stream_sessions": _with(
            "sessioned",
            """SELECT user_id, min(ms) * 1000 AS session_start, max(ms) * 1000 AS session_end,
                      CAST(count(*) AS BIGINT) AS events,
                      CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT)
                          AS items_purchased,
                      CAST(sum(price) FILTER (WHERE event_type = 'purchase') AS DOUBLE)
                          AS total_revenue
               FROM sessioned GROUP BY user_id, session_seq
               HAVING max(ms) + 1800000 <= (SELECT max(ms) FROM curated) - 3600000""",
        ),
        "stream_live_sessions": _with(
            "sessioned",
            """SELECT user_id, min(ms) * 1000 AS session_start, max(ms) * 1000 AS session_end,
                      CAST(count(*) AS BIGINT) AS events,
                      CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT)
                          AS items_purchased,
                      CAST(sum(price) FILTER (WHERE event_type = 'purchase') AS DOUBLE)
                          AS total_revenue
               FROM sessioned GROUP BY user_id, session_seq
               HAVING max(ms) + 1800000 <= (SELECT max(ms) FROM curated) - 3600000""",
        ),
    }
