"""One SQL text per registered query."""

from oracles.tables import PARAMETERS as P
from oracles.tables import avg, dbl, half_up, pct, ratio, with_tables
from tallywork.fixed_values import (
    GRANULARITIES,
    GROWTH_ABOVE,
    GROWTH_AT_LEAST,
    GROWTH_FIRST,
    GROWTH_REST,
    ORDER_STATUSES,
)


def _windows() -> dict[str, str]:
    classes = " ".join(
        f"WHEN rev {sign} prev * CAST({factor} AS DECIMAL(3,2)) THEN '{label}'"
        for sign, table in ((">", GROWTH_ABOVE), (">=", GROWTH_AT_LEAST))
        for label, factor in table
    )
    growth = with_tables(
        f"""
        WITH m AS (
          SELECT user_id, CAST(date_trunc('month', order_date) AS DATE) AS month,
                 CAST(SUM(net_revenue) AS DECIMAL(30,6)) AS rev
          FROM l_rev GROUP BY ALL),
        n AS (
          SELECT *, lag(rev) OVER w AS prev, lead(rev) OVER w AS nxt,
                 row_number() OVER w - 1 AS nth
          FROM m WINDOW w AS (PARTITION BY user_id ORDER BY month))
        SELECT user_id, month, {dbl('rev', 'monthly_revenue')}, {dbl('prev', 'prev_month_revenue')},
               {dbl('nxt', 'next_month_revenue')}, CAST(nth AS BIGINT) AS months_since_first_order,
               {pct('(rev - prev)', 'prev')} AS mom_growth_pct,
               CASE WHEN prev IS NULL THEN '{GROWTH_FIRST}'
                    {classes}
                    ELSE '{GROWTH_REST}' END AS growth_category
        FROM n""",
        "l_rev",
    )
    running = with_tables(
        f"""
        SELECT day, {dbl('rev', 'daily_rev')},
               CAST(SUM(rev) OVER so_far AS DOUBLE) AS cumulative_revenue,
               {avg('SUM(rev) OVER w7', 'COUNT(*) OVER w7', 2)} AS ma_7d,
               {avg('SUM(rev) OVER w30', 'COUNT(*) OVER w30', 2)} AS ma_30d,
               CAST(MAX(rev) OVER w7 AS DOUBLE) AS max_7d,
               {avg('SUM(rev) OVER so_far', 'COUNT(*) OVER so_far', 2)} AS expanding_avg,
               {pct('rev', '(SELECT SUM(rev) FROM l_daily)', 2)} AS pct_of_total_revenue
        FROM l_daily
        WINDOW so_far AS (ORDER BY day ROWS UNBOUNDED PRECEDING),
               w7 AS (ORDER BY day ROWS 6 PRECEDING), w30 AS (ORDER BY day ROWS 29 PRECEDING)""",
        "l_daily",
    )
    whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    return {
        "order_revenue": with_tables(
            f"""SELECT order_id, user_id, order_date, status, {dbl('net_revenue')},
                       {dbl('total_cost')}, {dbl('gross_profit')} FROM l_rev""",
            "l_rev",
        ),
        "rank_orders": with_tables(
            f"""
            SELECT user_id, order_id, CAST(order_date AS DATE) AS order_date, {dbl('net_revenue')},
                   row_number() OVER (ORDER BY net_revenue DESC, order_id) AS rn_overall,
                   rank() OVER (ORDER BY net_revenue DESC) AS rank_overall,
                   dense_rank() OVER (ORDER BY net_revenue DESC) AS dense_rank_overall,
                   row_number() OVER (PARTITION BY date_trunc('month', order_date)
                                      ORDER BY net_revenue DESC, order_id) AS rn_within_month,
                   ntile(100) OVER (ORDER BY net_revenue DESC, order_id) AS percentile_bucket
            FROM l_rev""",
            "l_rev",
        ),
        "top_n_per_user": with_tables(
            f"""
            SELECT user_id, order_id, CAST(order_date AS DATE) AS order_date, {dbl('net_revenue')},
                   row_number() OVER (PARTITION BY user_id ORDER BY net_revenue DESC, order_id)
                     AS revenue_rank
            FROM l_rev QUALIFY revenue_rank <= 3""",
            "l_rev",
        ),
        "mom_growth": growth,
        "running_totals": running,
        "first_last_value": with_tables(
            f"""
            WITH e AS (
              SELECT *, first_value(net_revenue) OVER w AS f_rev,
                     first_value(CAST(order_date AS DATE)) OVER w AS f_day,
                     last_value(net_revenue) OVER w AS l_last,
                     row_number() OVER (PARTITION BY user_id ORDER BY order_date, order_id) AS nth
              FROM l_rev WINDOW w AS (PARTITION BY user_id ORDER BY order_date, order_id {whole}))
            SELECT user_id, order_id, CAST(order_date AS DATE) AS order_date, {dbl('net_revenue')},
                   {dbl('f_rev', 'first_order_revenue')}, f_day AS first_order_date,
                   {dbl('l_last', 'latest_order_revenue')},
                   {pct('(net_revenue - f_rev)', 'f_rev')} AS pct_change_vs_first_order,
                   nth AS order_number
            FROM e""",
            "l_rev",
        ),
        "nth_value": with_tables(
            f"""
            SELECT user_id, order_id, order_date, {dbl('net_revenue')},
                   CAST(nth_value(net_revenue, 2) OVER (PARTITION BY user_id
                        ORDER BY order_date, order_id {whole}) AS DOUBLE) AS nth_value
            FROM l_rev""",
            "l_rev",
        ),
    }


def _histories() -> dict[str, str]:
    """Rows per user with what is before, around and after them."""
    so_far = "ROWS UNBOUNDED PRECEDING"
    frames = {n: f"ROWS {n - 1} PRECEDING" for n in (7, 30)}

    def mean(frame: str) -> str:
        over = f"OVER (PARTITION BY user_id ORDER BY order_date, order_id {frame})"
        return avg(f"SUM(net_revenue) {over}", f"COUNT(*) {over}", 2)

    over = "OVER (PARTITION BY user_id ORDER BY order_date, order_id"
    moving = f"""
        SELECT user_id, order_id, order_date, {dbl('net_revenue')},
               CAST(SUM(net_revenue) {over} {so_far}) AS DOUBLE) AS cumulative_revenue,
               {mean(so_far)} AS expanding_avg,
               {", ".join(f"{mean(frame)} AS ma_{n}" for n, frame in frames.items())},
               {", ".join(
                   f"CAST(MAX(net_revenue) {over} {frame}) AS DOUBLE) AS max_{n}"
                   for n, frame in frames.items()
               )},
               {pct('net_revenue', 'SUM(net_revenue) OVER (PARTITION BY user_id)', 2)}
                 AS pct_of_user_revenue
        FROM l_rev"""
    wait = "CAST(epoch_us(lead(event_at) OVER w) - epoch_us(event_at) AS DOUBLE) / 6e7"
    fill = f"""
        SELECT user_id, event_id, event_at, event_type,
               lead(event_type) OVER w AS next_event_type,
               {half_up(wait, 1)} AS minutes_to_next,
               last_value(CASE WHEN event_type = 'purchase' THEN event_at END IGNORE NULLS)
                 OVER (PARTITION BY user_id ORDER BY event_at, event_id {so_far}) AS last_goal_at,
               first_value(event_type) OVER whole AS first_event_type,
               last_value(event_type) OVER whole AS last_event_type
        FROM l_events WHERE user_id IS NOT NULL
        WINDOW w AS (PARTITION BY user_id ORDER BY event_at, event_id),
               whole AS (PARTITION BY user_id ORDER BY event_at, event_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""
    ranks = f"""
        SELECT user_id, order_id, {dbl('net_revenue')}, row_number() OVER u AS rn_in_user,
               rank() OVER w AS rank_in_user, dense_rank() OVER w AS dense_rank_in_user,
               ntile(4) OVER u AS bucket,
               CAST(SUM(net_revenue) OVER w AS DOUBLE) AS revenue_with_peers,
               COUNT(*) OVER w AS orders_with_peers
        FROM l_rev
        WINDOW w AS (PARTITION BY user_id ORDER BY net_revenue DESC),
               u AS (PARTITION BY user_id ORDER BY net_revenue DESC, order_id)"""
    return {
        "user_moving_metrics": with_tables(moving, "l_rev"),
        "user_event_fill": with_tables(fill, "l_events"),
        "ranks_per_user": with_tables(ranks, "l_rev"),
    }


def _cohorts() -> dict[str, str]:
    period = "datediff('month', cohort_month, month)"
    long = f"""
        c AS (SELECT cohort_month, {period} AS period, COUNT(*) AS active_users
              FROM tagged GROUP BY ALL),
        r AS (SELECT c.*, z.active_users AS cohort_size,
                     {pct('c.active_users', 'z.active_users')} AS retention_pct
              FROM c JOIN c z ON z.cohort_month = c.cohort_month AND z.period = 0)"""
    plain = f"WITH tagged AS (SELECT * FROM l_user_months), {long}"
    ranged = f"""
        WITH starts AS (
          SELECT user_id, CAST(date_trunc('month', MIN(order_date)) AS DATE) AS cohort_month
          FROM l_rev
          WHERE order_date BETWEEN TIMESTAMP '{P['cohort_from']}' AND TIMESTAMP '{P['cohort_to']}'
          GROUP BY user_id),
        tagged AS (
          SELECT s.cohort_month, u.month FROM l_user_months u JOIN starts s USING (user_id)
          WHERE u.month >= s.cohort_month AND datediff('month', s.cohort_month, u.month) <= 6),
        {long}"""
    columns = "SELECT cohort_month, cohort_size, period, active_users, retention_pct FROM r"
    wide = ", ".join(
        f"MAX(retention_pct) FILTER (WHERE period = {p}) AS m{p}_pct" for p in (0, 1, 2, 3, 6, 12)
    )
    api_wide = ", ".join(
        f"MAX(retention_pct) FILTER (WHERE period = {p}) AS M{p}" for p in range(7)
    )
    revenue = f"""
        WITH c AS (
          SELECT cohort_month, {period} AS period, COUNT(*) AS users, SUM(revenue) AS rev,
                 SUM(orders) AS n
          FROM l_user_months GROUP BY ALL),
        j AS (
          SELECT c.*, z.users AS size, z.rev AS base,
                 SUM(c.rev) OVER (PARTITION BY c.cohort_month ORDER BY c.period) AS so_far
          FROM c JOIN c z ON z.cohort_month = c.cohort_month AND z.period = 0)
        SELECT cohort_month, size AS cohort_size, period, users AS active_users,
               {dbl('round(rev, 2)', 'cohort_revenue')}, {avg('rev', 'n', 2)} AS avg_order_value,
               {avg('rev', 'users', 2)} AS revenue_per_active_user,
               {avg('so_far', 'size', 2)} AS cumulative_ltv_per_user,
               {pct('rev', 'base')} AS revenue_retention_pct
        FROM j"""
    return {
        "cohort_retention": with_tables(f"{plain} {columns}", "l_user_months"),
        "cohort_pivot": with_tables(
            f"{plain} SELECT cohort_month, cohort_size, {wide} FROM r GROUP BY ALL", "l_user_months"
        ),
        "cohort_revenue": with_tables(revenue, "l_user_months"),
        "cohort_api": with_tables(f"{ranged} {columns}", "l_user_months"),
        "cohort_api_wide": with_tables(
            f"{ranged} SELECT cohort_month, {api_wide} FROM r GROUP BY cohort_month", "l_user_months"
        ),
    }


def _funnels() -> dict[str, str]:
    steps = """COUNT(*) FILTER (WHERE viewed) AS v, COUNT(*) FILTER (WHERE carted) AS c,
               COUNT(*) FILTER (WHERE checked) AS k, COUNT(*) FILTER (WHERE bought) AS b"""
    rates = f"""{pct('c', 'v')} AS view_to_cart_pct, {pct('k', 'c')} AS cart_to_checkout_pct,
                {pct('b', 'k')} AS checkout_to_purchase_pct,
                {pct('b', 'v', 2)} AS overall_conversion_pct"""

    def metrics(segment: str) -> str:
        return with_tables(
            f"""
            WITH f AS (
              SELECT {segment} AS segment, COUNT(DISTINCT session_id) AS n,
                     COUNT(DISTINCT session_id) FILTER (WHERE event_type = 'add_to_cart') AS c,
                     COUNT(DISTINCT session_id) FILTER (WHERE event_type = 'checkout_start') AS k,
                     COUNT(DISTINCT session_id) FILTER (WHERE event_type = 'purchase') AS b
              FROM l_events
              WHERE event_at BETWEEN TIMESTAMP '{P['funnel_from']}' AND TIMESTAMP '{P['funnel_to']}'
              GROUP BY ALL)
            SELECT segment, n AS sessions, c AS add_to_cart, k AS checkout_start, b AS purchases,
                   {pct('c', 'n')} AS pv_to_cart_pct, {pct('k', 'c')} AS cart_to_checkout_pct,
                   {pct('b', 'n')} AS overall_conversion_pct
            FROM f""",
            "l_events",
        )

    convert = f"""
        WITH s AS (
          SELECT MIN(event_at) FILTER (WHERE event_type = 'page_view') AS a,
                 MIN(event_at) FILTER (WHERE event_type = 'purchase') AS b
          FROM l_events GROUP BY session_id),
        d AS (SELECT datediff('microsecond', a, b) AS us FROM s WHERE b >= a),
        g AS (SELECT COUNT(*) AS n, CAST(SUM(us) AS DOUBLE) AS total,
                     quantile_cont(us, 0.5) AS p50, quantile_cont(us, 0.9) AS p90 FROM d)
        SELECT n AS converting_sessions,
               {half_up('(total / 6e7 / nullif(n, 0))', 1)} AS avg_minutes_to_convert,
               {half_up('(p50 / 6e7)', 1)} AS median_minutes, {half_up('(p90 / 6e7)', 1)} AS p90_minutes
        FROM g"""
    dropoff = f"""
        WITH t AS (SELECT {steps} FROM l_sessions),
        u AS (SELECT unnest([
                {{'step': '1. Viewed', 'a': v, 'z': c}},
                {{'step': '2. Added to cart', 'a': c, 'z': k}},
                {{'step': '3. Started checkout', 'a': k, 'z': b}},
                {{'step': '4. Purchased', 'a': b, 'z': b}}], recursive := true) FROM t)
        SELECT step, a AS users_reached, a - z AS dropped_off,
               CASE WHEN step = '4. Purchased' THEN 0.0::DOUBLE
                    ELSE {pct('(a - z)', 'a')} END AS drop_off_pct
        FROM u"""
    five = """COUNT(*) FILTER (WHERE viewed) AS step1_page_view,
              COUNT(*) FILTER (WHERE carted) AS step2_add_to_cart,
              COUNT(*) FILTER (WHERE checked) AS step3_checkout_start,
              COUNT(*) FILTER (WHERE bought) AS step4_purchase,
              COUNT(*) FILTER (WHERE bounced) AS step5_error"""
    five_rates = f"""{pct('step2_add_to_cart', 'step1_page_view')} AS page_view_to_add_to_cart_pct,
                {pct('step3_checkout_start', 'step2_add_to_cart')} AS add_to_cart_to_checkout_start_pct,
                {pct('step4_purchase', 'step3_checkout_start')} AS checkout_start_to_purchase_pct,
                {pct('step5_error', 'step4_purchase')} AS purchase_to_error_pct,
                {pct('step5_error', 'step1_page_view', 2)} AS overall_conversion_pct"""
    return {
        "funnel_five_steps": with_tables(
            f"""WITH s AS (
                  SELECT session_id, bool_or(event_type = 'page_view') AS viewed,
                         bool_or(event_type = 'add_to_cart') AS carted,
                         bool_or(event_type = 'checkout_start') AS checked,
                         bool_or(event_type = 'purchase') AS bought,
                         bool_or(event_type = 'error') AS bounced
                  FROM l_events GROUP BY session_id),
                t AS (SELECT {five} FROM s)
                SELECT *, {five_rates} FROM t""",
            "l_events",
        ),
        "funnel_basic": with_tables(
            f"""WITH t AS (SELECT {steps} FROM l_sessions)
                SELECT v AS step1_page_views, c AS step2_add_to_cart, k AS step3_checkout,
                       b AS step4_purchase, {rates} FROM t""",
            "l_sessions",
        ),
        "funnel_by_device": with_tables(
            f"""WITH t AS (SELECT device, COUNT(*) AS n, {steps} FROM l_sessions GROUP BY device)
                SELECT device, n AS sessions, v AS views, b AS purchases, {rates} FROM t""",
            "l_sessions",
        ),
        "time_to_convert": with_tables(convert, "l_events"),
        "funnel_dropoff": with_tables(dropoff, "l_sessions"),
        "funnel_metrics": metrics("CAST(NULL AS VARCHAR)"),
        "funnel_metrics_device": metrics("device_type"),
        "funnel_metrics_referrer": metrics("referrer"),
    }


def _recurring() -> dict[str, str]:
    def movements(reactivation_first: bool) -> str:
        back = "WHEN prev = 0 AND mrr > 0 THEN 'reactivation'"
        first, last = (back, "") if reactivation_first else ("", back)
        sums = ", ".join(
            f"CAST(SUM(delta) FILTER (WHERE kind = '{k}') AS DOUBLE) AS {k}_mrr"
            for k in ("new", "expansion", "reactivation", "contraction", "churn")
        )
        return with_tables(
            f"""
            WITH s AS (
              SELECT CAST(date_trunc('month', started_at) AS DATE) AS month, mrr,
                     lag(mrr) OVER (PARTITION BY user_id ORDER BY started_at, sub_id) AS prev
              FROM l_subs),
            k AS (
              SELECT month, mrr - coalesce(prev, 0) AS delta,
                     CASE WHEN prev IS NULL AND mrr > 0 THEN 'new' {first}
                          WHEN mrr > prev THEN 'expansion'
                          WHEN mrr < prev AND mrr > 0 THEN 'contraction'
                          WHEN prev > 0 AND mrr = 0 THEN 'churn' {last} END AS kind
              FROM s WHERE mrr <> coalesce(prev, 0)),
            g AS (
              SELECT month, {sums}, SUM(delta) AS net,
                     COUNT(*) FILTER (WHERE kind = 'new') AS new_customers,
                     COUNT(*) FILTER (WHERE kind = 'churn') AS churned_customers,
                     COUNT(*) FILTER (WHERE kind = 'expansion') AS expanded_customers
              FROM k GROUP BY month)
            SELECT month, COLUMNS('.*_mrr'), {dbl('net', 'net_new_mrr')},
                   CAST(SUM(net) OVER (ORDER BY month) AS DOUBLE) AS ending_mrr,
                   COLUMNS('.*_customers')
            FROM g""",
            "l_subs",
        )

    churn = f"""
        WITH s AS (
          SELECT sub_id, user_id, CAST(date_trunc('month', started_at) AS DATE) AS month, mrr
          FROM l_subs WHERE ended_at IS NULL OR ended_at > started_at),
        p AS (SELECT *, lag(mrr) OVER (PARTITION BY user_id ORDER BY month, sub_id) AS prev FROM s),
        t AS (
          SELECT month, SUM(coalesce(prev, 0)) AS b, SUM(mrr) AS e,
                 coalesce(SUM(prev) FILTER (WHERE mrr = 0 AND prev > 0), 0) AS lost,
                 coalesce(SUM(mrr - prev) FILTER (WHERE mrr > prev AND prev > 0), 0) AS gain
          FROM p GROUP BY month)
        SELECT month, {dbl('b', 'beginning_mrr')}, {dbl('e', 'ending_mrr')},
               {dbl('lost', 'churned_mrr')}, {dbl('gain', 'expansion_mrr')},
               {pct('lost', 'b', 2)} AS gross_churn_rate_pct, {pct('(b + gain - lost)', 'b')} AS nrr_pct,
               {avg('(e - b + lost)', 'lost', 2)} AS quick_ratio
        FROM t"""
    exact = "CAST({} AS DECIMAL(28,6))"
    monthly = ratio("mon", "n")
    ltv = f"""
        WITH u AS (
          SELECT user_id, CAST(SUM(net_revenue) AS DECIMAL(34,6)) AS total, COUNT(*) AS n,
                 COUNT(DISTINCT date_trunc('month', order_date)) AS months,
                 MAX(order_date) <= (SELECT MAX(order_date) FROM l_orders) - INTERVAL 90 DAY AS gone
          FROM l_rev GROUP BY user_id),
        c AS (
          SELECT plan, acquired_channel, total, months, gone,
                 {exact.format(half_up(ratio('total', 'n'), 6))} AS aov,
                 {exact.format(half_up(ratio('total', 'months'), 6))} AS mon
          FROM u JOIN l_users USING (user_id)),
        g AS (
          SELECT plan, acquired_channel, COUNT(*) AS n, SUM(total) AS rev, SUM(aov) AS aov,
                 SUM(months) AS months, SUM(mon) AS mon, COUNT(*) FILTER (WHERE gone) AS gone,
                 quantile_cont(CAST(total AS DOUBLE), 0.9) AS p90
          FROM c GROUP BY ALL)
        SELECT plan, acquired_channel, n AS customer_count, {avg('rev', 'n', 2)} AS avg_total_revenue,
               {avg('aov', 'n', 2)} AS avg_order_value, {avg('months', 'n', 1)} AS avg_active_months,
               {half_up(monthly, 2)} AS avg_monthly_revenue,
               {half_up(f"({monthly} / nullif({ratio('gone', 'n')}, 0))", 2)} AS estimated_ltv,
               {half_up(f"(100.0 * {ratio('p90', 'rev')} * CAST(n AS DOUBLE) * 0.1)", 1)}
                 AS top10pct_revenue_share_pct
        FROM g"""

    def summary(granularity: str) -> str:
        return with_tables(
            f"""
            WITH g AS (
              SELECT CAST(date_trunc('{granularity}', order_date) AS DATE) AS period,
                     COUNT(DISTINCT user_id) AS users, COUNT(*) AS n, SUM(net_revenue) AS rev,
                     SUM(gross_profit) AS profit
              FROM l_rev GROUP BY ALL),
            h AS (SELECT *, CAST(round(rev, 2) AS DOUBLE) AS shown FROM g)
            SELECT period, users AS unique_customers, n AS total_orders, shown AS total_revenue,
                   {avg('rev', 'n', 2)} AS avg_order_value,
                   {dbl('round(profit, 2)', 'gross_profit')}, {pct('profit', 'rev')} AS gross_margin_pct,
                   (shown / nullif(lag(shown) OVER (ORDER BY period), 0) - 1) * 100 AS revenue_mom_pct
            FROM h""",
            "l_rev",
        )

    shown = "CAST(round(rev, 2) AS DOUBLE)"
    levels = " UNION ALL ".join(
        f"""SELECT '{g}' AS granularity, CAST(date_trunc('{g}', order_date) AS DATE) AS period,
                   COUNT(DISTINCT user_id) AS users, COUNT(*) AS n, SUM(net_revenue) AS rev,
                   SUM(gross_profit) AS profit
            FROM l_rev GROUP BY ALL"""
        for g in GRANULARITIES
    )
    rollups = f"""
        WITH g AS ({levels})
        SELECT granularity, period, users AS unique_customers, n AS total_orders,
               {dbl(shown, 'total_revenue')}, {avg('rev', 'n', 2)} AS avg_order_value,
               {dbl('round(profit, 2)', 'gross_profit')}, {pct('profit', 'rev')} AS gross_margin_pct,
               ({shown} / nullif(lag({shown}) OVER (PARTITION BY granularity ORDER BY period), 0) - 1)
                 * 100 AS revenue_mom_pct
        FROM g"""
    return {
        "revenue_rollups": with_tables(rollups, "l_rev"),
        "mrr_movements": movements(True),
        "mrr_movements_literal": movements(False),
        "churn_nrr": with_tables(churn, "l_subs"),
        "ltv_by_segment": with_tables(ltv, "l_rev", "l_users"),
        **{
            f"revenue_summary_{g}": summary(g) for g in ("day", "week", "month", "quarter", "year")
        },
    }


def _timeseries() -> dict[str, str]:
    def gap(carried: str) -> str:
        return with_tables(
            f"""
            WITH spine AS (
              SELECT CAST(unnest(generate_series(MIN(order_date), MAX(order_date), INTERVAL 1 DAY))
                          AS DATE) AS day
              FROM l_orders)
            SELECT spine.day, CAST(coalesce(rev, 0) AS DOUBLE) AS revenue, coalesce(n, 0) AS orders,
                   CAST({carried} AS DOUBLE) AS revenue_ffill
            FROM spine LEFT JOIN l_daily d ON d.day = spine.day""",
            "l_orders",
            "l_daily",
        )

    sessions = f"""
        WITH p AS (
          SELECT *, lag(event_at) OVER (PARTITION BY user_id ORDER BY event_at, event_id) AS before
          FROM l_events WHERE user_id IS NOT NULL),
        n AS (
          SELECT *, COUNT(*) FILTER (WHERE before IS NULL OR event_at > before + INTERVAL 30 MINUTE)
                    OVER (PARTITION BY user_id ORDER BY event_at, event_id
                          ROWS UNBOUNDED PRECEDING) AS num
          FROM p)
        SELECT user_id, num AS session_num, COUNT(*) AS events_in_session,
               MIN(event_at) AS session_start, MAX(event_at) AS session_end,
               {half_up("(CAST(datediff('microsecond', MIN(event_at), MAX(event_at)) AS DOUBLE) / 6e7)", 1)}
                 AS duration_min,
               bool_or(event_type = 'purchase') AS converted
        FROM n GROUP BY user_id, num"""
    ago = "lag(rev, 12) OVER (ORDER BY month)"
    prev = "lag(rev) OVER (ORDER BY month)"
    three = "OVER (ORDER BY month ROWS 2 PRECEDING)"

    def compare(months: str) -> str:
        return with_tables(
            f"""
            WITH t AS (
              SELECT CAST(date_trunc('month', day) AS DATE) AS month, SUM(rev) AS rev
              FROM l_daily GROUP BY ALL),
            m AS ({months})
            SELECT month, {dbl('rev', 'revenue')}, {dbl(prev, 'prev_month')},
                   {pct(f'(rev - {prev})', prev)} AS mom_pct, {dbl(ago, 'same_month_last_year')},
                   {pct(f'(rev - {ago})', ago)} AS yoy_pct,
                   {avg(f'SUM(rev) {three}', f'COUNT(*) {three}', 0)} AS ma_3mo
            FROM m""",
            "l_daily",
        )

    return {
        "gap_fill": gap("coalesce(rev, last_value(rev IGNORE NULLS) OVER (ORDER BY spine.day))"),
        "gap_fill_literal": gap("rev"),
        "mom_yoy": compare("SELECT * FROM t"),
        "mom_yoy_dense": compare(
            """
            SELECT CAST(month AS DATE) AS month, coalesce(rev, 0) AS rev
            FROM (SELECT unnest(generate_series(MIN(month), MAX(month), INTERVAL 1 MONTH)) AS month
                  FROM t) LEFT JOIN t USING (month)"""
        ),
        "rolling_activity": with_tables(
            f"""
            WITH d AS (
              SELECT day, dau, SUM(dau) OVER (ORDER BY day ROWS 6 PRECEDING) AS s7,
                     SUM(dau) OVER (ORDER BY day ROWS 29 PRECEDING) AS s30,
                     COUNT(*) OVER (ORDER BY day ROWS 29 PRECEDING) AS n30
              FROM l_daily)
            SELECT day, dau, CAST(s7 AS BIGINT) AS rolling_7d_activity,
                   CAST(s30 AS BIGINT) AS rolling_30d_activity,
                   {half_up(f"(100.0 * CAST(dau AS DOUBLE) / nullif({ratio('s30', 'n30')}, 0))", 1)}
                     AS dau_to_avg_ratio_pct
            FROM d""",
            "l_daily",
        ),
        "sessionize": with_tables(sessions, "l_events"),
        "daily_spine": with_tables(
            f"""
            WITH spine AS (
              SELECT CAST(unnest(generate_series((SELECT MIN(day) FROM l_daily),
                     (SELECT CAST(MAX(order_date) AS DATE) FROM l_orders), INTERVAL 1 DAY)) AS DATE) AS day)
            SELECT spine.day, {dbl('coalesce(rev, 0)', 'daily_revenue')},
                   coalesce(n, 0) AS order_count, rev IS NULL AS is_zero_day
            FROM spine LEFT JOIN l_daily d ON d.day = spine.day""",
            "l_daily",
            "l_orders",
        ),
    }


def _access() -> dict[str, str]:
    either = f"country = '{P['country']}' OR plan = '{P['plan']}'"
    per_user = """
        SELECT user_id, name, coalesce(n, 0) AS order_count
        FROM l_users LEFT JOIN (SELECT user_id, COUNT(*) AS n FROM l_orders GROUP BY user_id)
             USING (user_id)"""
    return {
        "org_tree": with_tables(
            """
            WITH t AS (
              SELECT emp_id, name, 1 AS depth, [emp_id] AS path, name AS full_path
              FROM l_emp WHERE manager_id IS NULL
              UNION ALL
              SELECT e.emp_id, e.name, t.depth + 1, list_append(t.path, e.emp_id),
                     t.full_path || ' > ' || e.name
              FROM t JOIN l_emp e ON e.manager_id = t.emp_id
              WHERE t.depth < 10 AND NOT list_contains(t.path, e.emp_id))
            SELECT emp_id, repeat(' ', 4 * (depth - 1)) || name AS indented_name,
                   CAST(depth AS BIGINT) AS depth, full_path, array_to_string(path, '/') AS path
            FROM t""",
            "l_emp",
            recursive=True,
        ),
        "lateral_top_n": with_tables(
            f"""
            SELECT user_id, email, plan, order_id, CAST(order_date AS DATE) AS order_date,
                   {dbl('net_revenue')},
                   row_number() OVER (PARTITION BY user_id ORDER BY net_revenue DESC, order_id)
                     AS revenue_rank
            FROM l_users JOIN l_rev USING (user_id) QUALIFY revenue_rank <= 2""",
            "l_users",
            "l_rev",
        ),
        "dedup_latest": with_tables(
            """
            SELECT * FROM l_events
            QUALIFY row_number() OVER (PARTITION BY user_id, session_id, event_type
                                       ORDER BY event_at DESC, event_id DESC) = 1""",
            "l_events",
        ),
        "dup_audit": with_tables(
            """
            SELECT user_id, session_id, event_type, COUNT(*) AS duplicate_count,
                   MIN(event_at) AS first_seen, MAX(event_at) AS last_seen,
                   datediff('microsecond', MIN(event_at), MAX(event_at)) / 1e6 AS time_span
            FROM l_events GROUP BY ALL HAVING COUNT(*) > 1""",
            "l_events",
        ),
        "email_variants": with_tables(
            r"""
            WITH e AS (
              SELECT user_id, email,
                     regexp_replace(lower(email), '^([^@+]*)\+[^@]*@', '\1@') AS normalised_email
              FROM l_users)
            SELECT e.*, n AS variants_count
            FROM e JOIN (SELECT normalised_email, COUNT(*) AS n FROM e GROUP BY ALL)
                 USING (normalised_email)""",
            "l_users",
        ),
        "country_revenue": with_tables(
            f"""
            SELECT country, COUNT(*) AS orders, {dbl('SUM(net_revenue)', 'revenue')}
            FROM l_rev JOIN l_users USING (user_id)
            WHERE created_at > (SELECT MAX(order_date) FROM l_orders) - INTERVAL 90 DAY
            GROUP BY country""",
            "l_rev",
            "l_users",
        ),
        "orders_per_user_corr": with_tables(per_user, "l_users", "l_orders"),
        "orders_per_user": with_tables(per_user, "l_users", "l_orders"),
        "orders_on_day": with_tables(
            f"SELECT * FROM l_orders WHERE CAST(order_date AS DATE) = DATE '{P['order_day']}'",
            "l_orders",
        ),
        "union_or": with_tables(f"SELECT DISTINCT * FROM l_users WHERE {either}", "l_users"),
        "or_filter": with_tables(f"SELECT * FROM l_users WHERE {either}", "l_users"),
        "has_events": with_tables(
            f"SELECT COUNT(*) > 0 AS has_events FROM l_events WHERE user_id = {P['event_user']}",
            "l_events",
        ),
        "keyset_page": with_tables(
            f"""SELECT * FROM l_orders WHERE order_id > {P['page_after']}
                ORDER BY order_id LIMIT 20""",
            "l_orders",
        ),
        **{
            name: with_tables(
                f"SELECT * FROM l_orders ORDER BY order_id LIMIT 20 OFFSET {P[offset]}", "l_orders"
            )
            for name, offset in (("offset_page", "page_offset"), ("offset_page_far", "far_offset"))
        },
        "events_month_pruned": with_tables(
            f"""
            SELECT *, CAST(date_trunc('month', event_at) AS DATE) AS event_month FROM l_events
            WHERE event_at >= TIMESTAMP '{P['month_from']}'
              AND event_at < TIMESTAMP '{P['month_to']}'""",
            "l_events",
        ),
        "orders_month_pruned": with_tables(
            f"""
            SELECT order_id, user_id, order_date, status,
                   CAST(date_trunc('month', order_date) AS DATE) AS event_month
            FROM l_orders
            WHERE order_date >= TIMESTAMP '{P['order_month_from']}'
              AND order_date < TIMESTAMP '{P['order_month_to']}'""",
            "l_orders",
        ),
        "chunk_event_counts": with_tables(
            "SELECT event_type, COUNT(*) AS n FROM l_events GROUP BY event_type", "l_events"
        ),
    }


def _daily_upsert(columns: str = "") -> str:
    def load(source: str) -> str:
        return f"""
          SELECT CAST(order_date AS DATE) AS period, COUNT(DISTINCT user_id) AS unique_customers,
                 COUNT(*) AS total_orders, {dbl('round(SUM(net_revenue), 2)', 'total_revenue')},
                 {dbl('round(SUM(gross_profit), 2)', 'gross_profit')}
          FROM {source} GROUP BY ALL"""

    return with_tables(
        f"""
        WITH a AS (SELECT * FROM ({load('l_all_rev')}) WHERE period <= DATE '{P['first_load_to']}'),
        b AS (SELECT * FROM ({load('l_rev')}) WHERE period >= DATE '{P['second_load_from']}')
        {columns or "SELECT * FROM b UNION ALL SELECT a.* FROM a WHERE period NOT IN (SELECT period FROM b)"}""",
        "l_all_rev",
        "l_rev",
    )


def _counts() -> str:
    names = {
        "users": "l_users",
        "products": "l_products",
        "orders": "l_orders",
        "order_items": "l_items",
        "events": "l_events",
        "subscriptions": "l_subs",
    }
    parts = [f"SELECT '{n}' AS tbl, COUNT(*) AS n FROM {t}" for n, t in names.items()]
    return with_tables(" UNION ALL ".join(parts), *names.values())


def _constraints() -> str:
    parts: list[str] = []

    def add(table: str, rule: str, count: str) -> None:
        parts.append(f"SELECT '{table}' AS table_name, '{rule}' AS rule, ({count}) AS violations")

    def checks(table: str, cte: str, required: str, **conditions: str) -> None:
        for column in required.split():
            add(table, f"{column} not null", f"SELECT COUNT(*) FROM {cte} WHERE {column} IS NULL")
        for rule, broken in conditions.items():
            add(table, rule.replace("__", " "), f"SELECT COUNT(*) FROM {cte} WHERE {broken}")

    def unique(table: str, cte: str, column: str) -> None:
        add(table, f"{column} unique", f"SELECT COUNT({column}) - COUNT(DISTINCT {column}) FROM {cte}")

    def inside(table: str, cte: str, column: str, parent: str, parent_cte: str, key: str) -> None:
        add(
            table,
            f"{column} in {parent}",
            f"SELECT COUNT(*) FROM {cte} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent_cte} p WHERE p.{key} = c.{column})",
        )

    checks(
        "users", "l_users", "user_id email name country plan created_at",
        plan__allowed="plan NOT IN ('free', 'starter', 'pro', 'enterprise')",
    )
    unique("users", "l_users", "user_id")
    unique("users", "l_users", "email")
    checks(
        "products", "l_products", "product_id name category price cost launched_at",
        price__positive="price <= 0", cost__positive="cost <= 0",
    )
    unique("products", "l_products", "product_id")
    checks(
        "orders", "l_orders", "order_id user_id order_date status shipping_country",
        status__allowed="status NOT IN ('pending', 'completed', 'refunded', 'cancelled')",
    )
    unique("orders", "l_orders", "order_id")
    inside("orders", "l_orders", "user_id", "users", "l_users", "user_id")
    checks(
        "order_items", "l_items", "order_id product_id quantity unit_price discount_pct",
        quantity__positive="quantity <= 0",
        discount_pct__range="discount_pct < 0 OR discount_pct > 100",
    )
    inside("order_items", "l_items", "order_id", "orders", "l_orders", "order_id")
    inside("order_items", "l_items", "product_id", "products", "l_products", "product_id")
    checks("events", "l_events", "event_id session_id event_type event_at")
    unique("events", "l_events", "event_id")
    inside("events", "l_events", "user_id", "users", "l_users", "user_id")
    inside("events", "l_events", "product_id", "products", "l_products", "product_id")
    checks(
        "subscriptions", "l_subs", "sub_id user_id plan mrr started_at",
        mrr__not__negative="mrr < 0",
    )
    unique("subscriptions", "l_subs", "sub_id")
    inside("subscriptions", "l_subs", "user_id", "users", "l_users", "user_id")
    checks("employees", "l_emp", "emp_id name")
    unique("employees", "l_emp", "emp_id")
    inside("employees", "l_emp", "manager_id", "employees", "l_emp", "emp_id")
    return with_tables(
        " UNION ALL ".join(parts),
        "l_users", "l_products", "l_orders", "l_items", "l_events", "l_subs", "l_emp",
    )


def _appended() -> str:
    allowed = ", ".join(f"'{s}'" for s in ORDER_STATUSES)
    return with_tables(
        f"""
        WITH first AS (SELECT * FROM l_orders WHERE order_id % 3 <> 0),
        sent AS (
          SELECT order_id, order_date, shipping_country,
                 CASE WHEN order_id % 7 = 0 THEN 'lost' ELSE status END AS status,
                 CASE WHEN order_id % 13 = 0 THEN user_id + 10000000
                      WHEN order_id % 11 <> 0 THEN user_id END AS user_id
          FROM l_orders WHERE order_id % 3 = 0 OR order_id % 10 = 0),
        twice AS (SELECT *, 1 AS nth FROM sent UNION ALL SELECT *, 2 FROM sent WHERE order_id % 9 = 0),
        judged AS (
          SELECT order_id, nth, list_filter([
                   CASE WHEN user_id IS NULL THEN 'user_id not null' END,
                   CASE WHEN status NOT IN ({allowed}) THEN 'status allowed' END,
                   CASE WHEN user_id NOT IN (SELECT user_id FROM l_users) THEN 'user_id in users' END,
                   CASE WHEN order_id IN (SELECT order_id FROM first) THEN 'order_id unique' END
                 ], lambda x: x IS NOT NULL) AS broken
          FROM twice),
        all_rows AS (
          SELECT order_id, CASE WHEN len(broken) = 0 AND nth = 2 THEN ['order_id unique'] ELSE broken END AS broken
          FROM judged
          UNION ALL SELECT order_id, [] FROM first)
        SELECT array_to_string(list_sort(broken), ', ') AS broken, COUNT(*) AS n,
               CAST(SUM(order_id) AS BIGINT) AS order_ids
        FROM all_rows GROUP BY ALL""",
        "l_orders", "l_users",
    )


def sql() -> dict[str, str]:
    return {
        **_windows(),
        **_histories(),
        **_cohorts(),
        **_funnels(),
        **_recurring(),
        **_timeseries(),
        **_access(),
        "daily_summary_upsert": _daily_upsert(),
        "daily_summary_columns": _daily_upsert(
            """SELECT coalesce(b.period, a.period) AS period, a.unique_customers,
                      CASE WHEN b.period IS NULL THEN a.total_orders ELSE b.total_orders END AS total_orders,
                      CASE WHEN b.period IS NULL THEN a.total_revenue ELSE b.total_revenue END
                        AS total_revenue,
                      a.gross_profit
               FROM a FULL JOIN b ON a.period = b.period"""
        ),
        "append_checked": _appended(),
        "user_totals_by_bucket": with_tables(
            """SELECT user_id, plan, COUNT(*) AS orders, MAX(order_date) AS last_order
               FROM l_orders JOIN l_users USING (user_id) GROUP BY ALL""",
            "l_orders", "l_users",
        ),
        "table_counts": _counts(),
        "constraint_report": _constraints(),
    }
