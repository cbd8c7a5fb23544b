"""The logical tables as CTEs, and the parameters shared with the Spark queries."""

PARAMETERS = {
    "event_user": 42,
    "country": "NATION_7",
    "plan": "pro",
    "page_after": 1000,
    "page_offset": 100,
    "far_offset": 10_000,
    "order_month_from": "1997-02-10",
    "order_month_to": "1997-04-20",
    "order_day": "1998-10-03",
    "month_from": "2024-01-05",
    "month_to": "2024-01-25",
    "funnel_from": "2024-01-03",
    "funnel_to": "2024-01-20",
    "cohort_from": "1996-01-01",
    "cohort_to": "1998-06-30",
    "first_load_to": "1999-12-31",
    "second_load_from": "1999-07-01",
}

# name -> (names it reads, text)
CTES = {
    "l_users": (
        (),
        """
        SELECT c_custkey AS user_id,
               CASE c_custkey % 4
                    WHEN 0 THEN 'user' || CAST((c_custkey - c_custkey % 4) // 4 AS VARCHAR) || '@example.com'
                    WHEN 1 THEN 'User' || CAST((c_custkey - c_custkey % 4) // 4 AS VARCHAR) || '+promo@Example.com'
                    WHEN 2 THEN 'user' || CAST((c_custkey - c_custkey % 4) // 4 AS VARCHAR) || '+b@example.com'
                    ELSE 'solo' || CAST((c_custkey - c_custkey % 4) // 4 AS VARCHAR) || '@example.com'
               END AS email,
               c_name AS name, n_name AS country,
               CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'free'
                    WHEN c_mktsegment = 'AUTOMOBILE' THEN 'starter'
                    WHEN c_mktsegment = 'MACHINERY' THEN 'pro'
                    WHEN c_mktsegment = 'HOUSEHOLD' THEN 'enterprise' END AS plan,
               ['organic', 'paid', 'referral', 'direct'][c_custkey % 4 + 1] AS acquired_channel,
               TIMESTAMP '1999-01-01' + to_days(CAST(c_custkey * 37 % 900 AS INTEGER)) AS created_at,
               CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '1999-01-01'
                    + to_days(CAST(c_custkey * 37 % 900 + 100 AS INTEGER)) END AS churned_at
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "l_products": (
        (),
        """
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS subcategory,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price,
               CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.60 AS DECIMAL(3,2)) AS cost,
               DATE '2022-01-01' + CAST(p_partkey % 800 AS INTEGER) AS launched_at
        FROM part""",
    ),
    "l_orders": (
        ("l_users",),
        """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN 'completed'
                    WHEN o_orderkey % 2 = 0 THEN 'refunded' ELSE 'cancelled' END AS status,
               country AS shipping_country
        FROM orders LEFT JOIN l_users ON user_id = o_custkey""",
    ),
    "l_items": (
        ("l_products",),
        """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               price AS unit_price, CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_pct
        FROM lineitem LEFT JOIN l_products ON product_id = l_partkey""",
    ),
    "l_events": (
        (),
        """
        SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN user_id END AS user_id,
               'sess_' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
               CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
                    WHEN 'signup' THEN 'checkout_start' ELSE event_type END AS event_type,
               event_id % 200 AS product_id, ts AS event_at,
               ['mobile', 'mobile', 'desktop', 'tablet'][k % 4 + 1] AS device_type,
               ['google', 'direct', 'facebook', 'email', 'referral'][k % 5 + 1] AS referrer
        FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events)""",
    ),
    "l_subs": (
        (),
        """
        SELECT o_orderkey AS sub_id, o_custkey AS user_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'enterprise' WHEN '2-HIGH' THEN 'pro'
                    ELSE 'starter' END AS plan,
               CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 4999 WHEN '2-HIGH' THEN 1999
                    WHEN '3-MEDIUM' THEN 499 WHEN '4-NOT SPECIFIED' THEN 499 ELSE 0 END
                    AS DECIMAL(10,2)) AS mrr,
               CAST(o_orderdate AS DATE) AS started_at,
               CASE WHEN o_orderstatus = 'F'
                    THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 - 5 AS INTEGER) END AS ended_at
        FROM orders""",
    ),
    "l_emp": (
        (),
        """
        SELECT c_custkey + 1 AS emp_id, c_name AS name,
               CASE WHEN c_custkey <> 0
                    THEN CAST(floor((c_custkey - 1) / 10) AS BIGINT) + 1 END AS manager_id
        FROM customer""",
    ),
    "l_all_rev": (
        ("l_orders", "l_items", "l_products"),
        """
        SELECT o.order_id, o.user_id, o.order_date, o.status, i.net_revenue, i.total_cost,
               i.net_revenue - i.total_cost AS gross_profit
        FROM l_orders o
        JOIN (SELECT order_id,
                     SUM(CAST(quantity * unit_price * (1 - discount_pct * CAST(0.01 AS DECIMAL(3,2)))
                              AS DECIMAL(24,6))) AS net_revenue,
                     SUM(CAST(quantity * cost AS DECIMAL(24,4))) AS total_cost
              FROM l_items JOIN l_products USING (product_id) GROUP BY order_id) i
          ON i.order_id = o.order_id""",
    ),
    "l_rev": (("l_all_rev",), " SELECT * FROM l_all_rev WHERE status = 'completed'"),
    # one row per user and active month, with the month of the user's first order
    "l_user_months": (
        ("l_rev",),
        """
        SELECT user_id, month, revenue, orders, MIN(month) OVER (PARTITION BY user_id) AS cohort_month
        FROM (SELECT user_id, CAST(date_trunc('month', order_date) AS DATE) AS month,
                     SUM(net_revenue) AS revenue, COUNT(*) AS orders
              FROM l_rev GROUP BY ALL)""",
    ),
    "l_sessions": (
        ("l_events",),
        """
        SELECT session_id, bool_or(event_type = 'page_view') AS viewed,
               bool_or(event_type = 'add_to_cart') AS carted,
               bool_or(event_type = 'checkout_start') AS checked,
               bool_or(event_type = 'purchase') AS bought,
               mode() WITHIN GROUP (ORDER BY device_type) AS device
        FROM l_events GROUP BY session_id""",
    ),
    "l_daily": (
        ("l_rev",),
        """
        SELECT CAST(order_date AS DATE) AS day, SUM(net_revenue) AS rev, COUNT(*) AS n,
               COUNT(DISTINCT user_id) AS dau
        FROM l_rev GROUP BY ALL""",
    ),
}


def with_tables(body: str, *names: str, recursive: bool = False) -> str:
    """Prefix ``body`` with the CTEs it needs. A body that starts with WITH adds its own."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name not in needed:
            for other in CTES[name][0]:
                add(other)
            needed.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in needed)
    body = body.strip()
    joint = ",\n" + body[4:] if body.upper().startswith("WITH") else "\n" + body
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}{joint}"


def half_up(x: str, digits: int) -> str:
    return f"(sign({x}) * (floor(abs({x}) * 1e{digits} + 0.5) / 1e{digits}) + 0.0)"


def ratio(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0))"


def pct(top: str, bottom: str, digits: int = 1) -> str:
    return half_up(f"(100.0 * CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0))", digits)


def avg(total: str, count: str, digits: int) -> str:
    return half_up(ratio(total, count), digits)


def dbl(expression: str, alias: str = "") -> str:
    return f"CAST({expression} AS DOUBLE) AS {alias or expression}"
