"""Small frames with answers worked out by hand."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywork import Analytics
from tallywork import operators as op
from tallywork.functions import half_up, percent, period_of
from tallywork.sources.tables import Check, ForeignKey, Unique

REVENUE = "order_id bigint, user_id bigint, order_date timestamp_ntz, net_revenue decimal(12,2)"
EVENTS = (
    "event_id bigint, user_id bigint, session_id string, event_type string, "
    "event_at timestamp_ntz, device_type string, referrer string"
)


def d(text):
    return Decimal(text)


def at(text):
    return datetime.fromisoformat(text)


def by(df, *keys):
    """Rows as dicts under the value (or tuple) of their key columns."""
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}


def test_rounding(spark):
    values = [1.005, 2.5, -2.5, 0.04, -0.04, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(half_up(F.col("v"), 0)).collect()]
    assert got == [1.0, 3.0, -3.0, 0.0, 0.0, None]
    assert df.select(half_up(F.lit(12.25), 1), percent(F.lit(1), F.lit(0))).first()[:] == (12.3, None)


def test_order_revenue(frame):
    orders = frame(
        [(1, 10, at("2024-01-01"), "completed"), (2, 10, at("2024-01-02"), "refunded")],
        "order_id bigint, user_id bigint, order_date timestamp_ntz, status string",
    )
    items = frame(
        [(1, 1, 3, d("9.99"), d("10.00")), (1, 2, 1, d("5.00"), d("0")), (2, 1, 1, d("9.99"), d("0"))],
        "order_id bigint, product_id bigint, quantity int, unit_price decimal(10,2), "
        "discount_pct decimal(5,2)",
    )
    products = frame([(1, d("4.00")), (2, d("6.50"))], "product_id bigint, cost decimal(10,2)")
    rows = by(op.order_revenue(orders, items, products), "order_id")
    assert list(rows) == [1]
    assert rows[1]["net_revenue"] == d("31.973")
    assert rows[1]["total_cost"] == d("18.50")
    assert rows[1]["gross_profit"] == d("13.473")
    assert set(by(op.order_revenue(orders, items, products, status=None), "order_id")) == {1, 2}


def test_rank_ties(frame):
    amounts = [50, 30, 30, 10]
    rows = [(i, i, at("2024-01-05"), d(a)) for i, a in enumerate(amounts, 1)]
    rows.append((5, 5, at("2024-02-05"), d(30)))
    ranked = by(op.rank_orders(frame(rows, REVENUE)), "order_id")

    def column(name):
        return [ranked[i][name] for i in range(1, 6)]

    assert column("rn_overall") == [1, 2, 3, 5, 4]
    assert column("rank_overall") == [1, 2, 2, 5, 2]
    assert column("dense_rank_overall") == [1, 2, 2, 3, 2]
    assert column("rn_within_month") == [1, 2, 3, 4, 1]
    assert column("percentile_bucket") == [1, 2, 3, 5, 4]  # fewer rows than buckets


def test_growth_classes(frame):
    steps = ["100", "120", "126", "119.7", "95.76", "90", "0", "5"]
    months = [1, 2, 3, 4, 5, 6, 8, 9]  # July has no order
    rows = [(i, 1, datetime(2024, m, 3), d(v)) for i, (m, v) in enumerate(zip(months, steps))]
    rows.append((99, 1, datetime(2024, 10, 1), d("6.5")))
    out = by(op.period_growth(frame(rows, REVENUE)), "month")
    classes = [out[m]["growth_category"] for m in sorted(out)]
    assert classes == [
        "first_order",
        "moderate_growth",  # exactly 1.20 times
        "stable",  # exactly 1.05 times
        "stable",  # exactly 0.95 times
        "declining",  # exactly 0.80 times
        "declining",
        "significant_decline",
        "strong_growth",  # from nothing
        "strong_growth",
    ]
    august = out[date(2024, 8, 1)]
    assert august["months_since_first_order"] == 6
    assert august["prev_month_revenue"] == 90 and august["mom_growth_pct"] == -100.0
    assert out[date(2024, 9, 1)]["mom_growth_pct"] is None  # previous month was 0
    assert out[date(2024, 1, 1)]["next_month_revenue"] == 120


def test_running_metrics(frame):
    rows = [(i, 1, datetime(2024, 1, 1 + i), d(v)) for i, v in enumerate([10, 20, 30, 0, 40])]
    out = by(op.running_metrics(frame(rows, REVENUE)), "day")
    last = out[date(2024, 1, 5)]
    assert last["cumulative_revenue"] == 100 and last["ma_7d"] == 20.0
    assert last["max_7d"] == 40 and last["pct_of_total_revenue"] == 40.0
    assert out[date(2024, 1, 2)]["expanding_avg"] == 15.0


def test_first_last_and_nth(frame):
    rows = [
        (1, 1, at("2024-01-01"), d(0)),
        (2, 1, at("2024-01-02"), d(20)),
        (3, 2, at("2024-01-03"), d(50)),
        (4, 2, at("2024-01-04"), d(75)),
        (5, 3, at("2024-01-04"), d(1)),
    ]
    revenue = frame(rows, REVENUE)
    out = by(op.first_last_compare(revenue), "order_id")
    assert out[2]["pct_change_vs_first_order"] is None  # the first order was 0
    assert out[4]["pct_change_vs_first_order"] == 50.0 and out[4]["order_number"] == 2
    assert out[3]["latest_order_revenue"] == 75
    assert out[3]["first_order_date"] == date(2024, 1, 3)
    nth = op.nth_per_group(revenue, "user_id", ["order_date", "order_id"], 2, "net_revenue")
    assert {k: v["nth_value"] for k, v in by(nth, "order_id").items()} == {
        1: 20, 2: 20, 3: 75, 4: 75, 5: None,
    }


COHORT = [
    (1, 1, at("2024-01-10"), d(10)),
    (2, 1, at("2024-01-20"), d(20)),
    (3, 1, at("2024-03-01"), d(5)),
    (4, 2, at("2024-01-31"), d(30)),
    (5, 2, at("2025-02-01"), d(40)),  # back after thirteen months
    (6, 3, at("2024-03-15"), d(8)),
]


def test_cohort_retention(frame):
    revenue = frame(COHORT, REVENUE)
    out = by(op.cohort_retention(revenue), "cohort_month", "period")
    january = date(2024, 1, 1)
    assert set(out) == {(january, 0), (january, 2), (january, 13), (date(2024, 3, 1), 0)}
    assert out[january, 2]["retention_pct"] == 50.0 and out[january, 2]["cohort_size"] == 2
    wide = by(op.cohort_retention_wide(revenue), "cohort_month")[january]
    assert (wide["m0_pct"], wide["m1_pct"], wide["m2_pct"]) == (100.0, None, 50.0)


def test_cohort_revenue(frame):
    out = by(op.cohort_revenue(frame(COHORT, REVENUE)), "cohort_month", "period")
    january = date(2024, 1, 1)
    first, later = out[january, 0], out[january, 2]
    assert first["cohort_revenue"] == 60 and first["avg_order_value"] == 20.0
    assert first["revenue_per_active_user"] == 30.0
    assert later["cumulative_ltv_per_user"] == 32.5 and later["revenue_retention_pct"] == 8.3


def test_cohort_range_moves_a_first_order(frame):
    revenue = frame(COHORT, REVENUE)
    start, end = at("2024-02-01"), at("2024-12-31")
    long = by(
        op.cohort_retention_range(revenue, start, end, max_period=1, wide=False),
        "cohort_month",
        "period",
    )
    # user 1 counts from March on; user 2 has no order inside the window
    assert list(long) == [(date(2024, 3, 1), 0)] and long[date(2024, 3, 1), 0]["cohort_size"] == 2
    table = op.cohort_retention_range(revenue, at("2024-01-01"), max_period=2)
    assert table.columns == ["cohort_month", "M0", "M1", "M2"]
    assert by(table, "cohort_month")[date(2024, 1, 1)]["M2"] == 50.0


def events_frame(frame, rows):
    full = []
    for i, (session, kind, when, device) in enumerate(rows):
        full.append((i, 1, session, kind, at(f"2024-01-01 {when}"), device, "direct"))
    return frame(full, EVENTS)


FUNNEL = [
    ("a", "page_view", "10:00", "mobile"),
    ("a", "add_to_cart", "10:05", "desktop"),  # device tie, the smaller name wins
    ("b", "purchase", "10:00", "mobile"),  # before its view
    ("b", "page_view", "10:10", "mobile"),
    ("c", "purchase", "11:00", "tablet"),  # without a view
    ("d", "page_view", "12:00", None),
    ("d", "purchase", "12:30", None),
    ("e", "page_view", "13:00", "mobile"),
    ("e", "purchase", "13:10", "mobile"),
]


def test_funnel(frame):
    row = op.funnel(events_frame(frame, FUNNEL)).first()
    assert row["step1_page_views"] == 4 and row["step2_add_to_cart"] == 1
    assert row["step3_checkout"] == 0 and row["step4_purchase"] == 4
    assert row["cart_to_checkout_pct"] == 0.0
    assert row["checkout_to_purchase_pct"] is None  # nobody reached the checkout
    assert row["overall_conversion_pct"] == 100.0


def test_funnel_by_device(frame):
    out = by(op.funnel_by_segment(events_frame(frame, FUNNEL)), "device")
    assert {k: v["sessions"] for k, v in out.items()} == {
        "desktop": 1, "mobile": 2, "tablet": 1, None: 1,
    }
    assert out["desktop"]["views"] == 1 and out["desktop"]["view_to_cart_pct"] == 100.0
    assert out["tablet"]["overall_conversion_pct"] is None


def test_time_to_convert(frame):
    row = op.time_to_convert(events_frame(frame, FUNNEL)).first()
    assert row["converting_sessions"] == 2  # d in 30 minutes, e in 10
    assert row["avg_minutes_to_convert"] == 20.0 and row["median_minutes"] == 20.0
    assert row["p90_minutes"] == 28.0
    none = op.time_to_convert(events_frame(frame, FUNNEL[:2])).first()
    assert none["converting_sessions"] == 0 and none["median_minutes"] is None


def test_funnel_dropoff(frame):
    out = by(op.funnel_dropoff(events_frame(frame, FUNNEL)), "step")
    assert out["1. Viewed"]["dropped_off"] == 3 and out["1. Viewed"]["drop_off_pct"] == 75.0
    assert out["3. Started checkout"]["drop_off_pct"] is None
    assert out["4. Purchased"]["dropped_off"] == 0 and out["4. Purchased"]["drop_off_pct"] == 0.0


def test_funnel_metrics(frame):
    events = events_frame(frame, FUNNEL)
    start, end = at("2024-01-01 10:00"), at("2024-01-01 12:00")
    row = op.funnel_metrics(events, start, end).first()
    assert (row["segment"], row["sessions"], row["purchases"]) == (None, 4, 2)
    devices = by(op.funnel_metrics(events, start, end, segment_by="device_type"), "segment")
    assert devices["mobile"]["sessions"] == 2 and devices["desktop"]["sessions"] == 1
    # any other column gives the unsegmented row
    assert op.funnel_metrics(events, start, end, segment_by="session_id").count() == 1


SUBSCRIPTIONS = "sub_id bigint, user_id bigint, mrr decimal(10,2), started_at date, ended_at date"


def test_mrr_movements(frame):
    rows = [
        (1, 1, d(0), date(2024, 1, 1), None),  # nothing to report yet
        (2, 1, d(100), date(2024, 2, 1), None),  # 0 to 100
        (3, 1, d(0), date(2024, 3, 1), None),  # churn
        (4, 1, d(50), date(2024, 4, 1), None),  # back
        (5, 2, d(70), date(2024, 1, 5), None),  # new
        (6, 2, d(70), date(2024, 2, 5), None),  # unchanged
        (7, 2, d(90), date(2024, 3, 5), None),  # expansion
        (8, 2, d(60), date(2024, 3, 5), None),  # same day, later record: contraction
    ]
    subs = frame(rows, SUBSCRIPTIONS)
    out = by(op.mrr_movements(subs), "month")
    assert out[date(2024, 1, 1)]["new_mrr"] == 70
    assert out[date(2024, 1, 1)]["churn_mrr"] is None
    assert out[date(2024, 2, 1)]["reactivation_mrr"] == 100
    march = out[date(2024, 3, 1)]
    assert march["churn_mrr"] == -100 and march["expansion_mrr"] == 20
    assert march["contraction_mrr"] == -30 and march["net_new_mrr"] == -110
    assert out[date(2024, 4, 1)]["ending_mrr"] == 110
    literal = by(op.mrr_movements(subs, literal=True), "month")
    assert literal[date(2024, 2, 1)]["expansion_mrr"] == 100
    assert literal[date(2024, 2, 1)]["reactivation_mrr"] is None


def test_churn_nrr(frame):
    rows = [
        (1, 1, d(100), date(2024, 1, 1), None),
        (2, 1, d(0), date(2024, 2, 1), None),
        (3, 2, d(50), date(2024, 1, 1), date(2024, 1, 1)),  # ended at once, left out
        (4, 2, d(60), date(2024, 1, 9), None),
        (5, 2, d(90), date(2024, 2, 9), None),
    ]
    out = by(op.churn_nrr(frame(rows, SUBSCRIPTIONS)), "month")
    january, february = out[date(2024, 1, 1)], out[date(2024, 2, 1)]
    assert january["beginning_mrr"] == 0 and january["gross_churn_rate_pct"] is None
    assert february["beginning_mrr"] == 160 and february["ending_mrr"] == 90
    assert february["churned_mrr"] == 100 and february["expansion_mrr"] == 30
    assert february["gross_churn_rate_pct"] == 62.5 and february["nrr_pct"] == 56.3
    assert february["quick_ratio"] == 0.3


def test_ltv_by_segment(frame):
    users = frame(
        [(1, "pro", "paid"), (2, "pro", "paid"), (3, "free", None)],
        "user_id bigint, plan string, acquired_channel string",
    )
    rows = [
        (1, 1, at("2024-01-01"), d(100)),
        (2, 1, at("2024-02-01"), d(200)),
        (3, 2, at("2024-06-01"), d(50)),
        (4, 3, at("2024-06-01"), d(10)),
    ]
    now = F.lit(at("2024-06-30"))
    out = by(op.ltv_by_segment(users, frame(rows, REVENUE), as_of=now), "plan")
    pro = out["pro"]
    assert pro["customer_count"] == 2 and pro["avg_total_revenue"] == 175.0
    assert pro["avg_monthly_revenue"] == 100.0 and pro["avg_active_months"] == 1.5
    assert pro["estimated_ltv"] == 200.0  # half of the customers are inactive
    assert pro["top10pct_revenue_share_pct"] == 15.7  # p90 is 325: 50 + 0.9 * 250 = 275
    assert out["free"]["estimated_ltv"] is None and out["free"]["acquired_channel"] is None


def test_gap_fill(frame):
    orders = frame(
        [(1, at("2024-01-01")), (2, at("2024-01-02 09:00")), (3, at("2024-01-05"))],
        "order_id bigint, order_date timestamp_ntz",
    )
    revenue = frame([(2, 1, at("2024-01-02 09:00"), d(7))], REVENUE)
    out = by(op.gap_fill(orders, revenue), "day")
    assert len(out) == 5
    assert out[date(2024, 1, 1)]["revenue_ffill"] is None and out[date(2024, 1, 1)]["revenue"] == 0
    assert out[date(2024, 1, 5)]["revenue_ffill"] == 7 and out[date(2024, 1, 5)]["orders"] == 0
    literal = by(op.gap_fill(orders, revenue, literal=True), "day")
    assert literal[date(2024, 1, 5)]["revenue_ffill"] is None


def test_date_spine_fill(frame):
    revenue = frame([(1, 1, at("2024-01-02"), d(7)), (2, 1, at("2024-01-04"), d(0))], REVENUE)
    out = by(op.date_spine_fill(revenue, as_of=F.lit(at("2024-01-05"))), "day")
    assert [out[k]["is_zero_day"] for k in sorted(out)] == [False, True, False, True]
    assert out[date(2024, 1, 3)]["order_count"] == 0
    early = op.date_spine_fill(revenue, as_of=F.lit(at("2023-01-05")))
    assert [r["day"] for r in early.collect()] == [date(2024, 1, 2)]


def test_period_over_period_counts_rows(frame):
    months = [date(2023, m, 1) for m in range(1, 13)] + [date(2024, 2, 1)]  # January is missing
    rows = [(i, 1, datetime(m.year, m.month, 5), d(100 + i)) for i, m in enumerate(months)]
    out = by(op.period_over_period(frame(rows, REVENUE)), "month")
    last = out[date(2024, 2, 1)]
    assert last["same_month_last_year"] == 100  # twelve rows back
    assert last["yoy_pct"] == 12.0 and last["ma_3mo"] == 111.0
    dense = by(op.period_over_period(frame(rows, REVENUE), dense=True), "month")
    assert dense[date(2024, 1, 1)]["revenue"] == 0 and dense[date(2024, 2, 1)]["mom_pct"] is None
    assert dense[date(2024, 2, 1)]["same_month_last_year"] == 101  # twelve calendar months back
    assert dense[date(2024, 2, 1)]["ma_3mo"] == 74.0


@pytest.mark.parametrize(
    "granularity, rows", [("day", 397), ("week", 58), ("month", 14), ("quarter", 5), ("year", 2)]
)
def test_dense_periods(frame, granularity, rows):
    ends = [(1, 1, at("2023-01-05"), d(1)), (2, 1, at("2023-07-20"), d(1)), (3, 1, at("2024-02-05"), d(1))]
    out = op.period_over_period(frame(ends, REVENUE), granularity=granularity, dense=True)
    assert out.count() == rows
    assert out.agg(F.sum("revenue")).first()[0] == 3


def test_rolling_activity(frame):
    rows = [
        (1, 1, at("2024-01-01"), d(1)),
        (2, 1, at("2024-01-01 12:00"), d(1)),
        (3, 1, at("2024-01-02"), d(1)),
        (4, 2, at("2024-01-02"), d(1)),
    ]
    out = by(op.rolling_activity(frame(rows, REVENUE)), "day")
    assert out[date(2024, 1, 1)]["dau"] == 1
    assert out[date(2024, 1, 2)]["rolling_7d_activity"] == 3
    assert out[date(2024, 1, 2)]["dau_to_avg_ratio_pct"] == 133.3


def test_sessionize_edges(frame):
    base = at("2024-01-01 10:00")
    offsets = [
        timedelta(0),
        timedelta(minutes=30),  # exactly the gap: same session
        timedelta(minutes=60, microseconds=1),  # just over: new session
        timedelta(minutes=60, microseconds=1),  # equal times
    ]
    rows = [(i, 1, "s", "page_view", base + o, None, None) for i, o in enumerate(offsets)]
    rows.append((8, 2, "s", "purchase", base, None, None))
    rows.append((9, None, "s", "purchase", base, None, None))
    out = by(op.sessionize(frame(rows, EVENTS)), "user_id", "session_num")
    assert {k: v["events_in_session"] for k, v in out.items()} == {(1, 1): 2, (1, 2): 2, (2, 1): 1}
    assert out[1, 1]["duration_min"] == 30.0 and out[1, 1]["converted"] is False
    assert out[2, 1]["converted"] is True


def test_hierarchy(frame):
    rows = [(1, "a", None), (2, "b", 1), (3, "c", 2), (10, "r", None)]
    rows += [(20, "x", 21), (21, "y", 20)]  # a cycle
    rows += [(40, None, 1), (41, "q", 40)]  # a missing name
    rows += [(30, "self", 30), (31, "lost", 99)]  # its own parent; a missing parent
    rows += [(100, "d", 10)] + [(100 + i, f"d{i}", 99 + i) for i in range(1, 12)]
    df = frame(rows, "emp_id bigint, name string, manager_id bigint")
    out = by(op.traverse_hierarchy(df), "emp_id")
    assert set(out) == {1, 2, 3, 10, 40, 41} | set(range(100, 109))  # down to depth 10
    assert out[41]["full_path"] is None and out[41]["depth"] == 3
    assert out[3]["depth"] == 3 and out[3]["full_path"] == "a > b > c"
    assert out[3]["indented_name"] == "        c" and out[3]["path"] == [1, 2, 3]
    assert out[108]["depth"] == 10
    assert set(by(op.traverse_hierarchy(df, max_depth=1), "emp_id")) == {1, 10}
    assert set(by(op.traverse_hierarchy(df, max_depth=2), "emp_id")) == {1, 2, 10, 40, 100}


def test_duplicates(frame):
    t1, t2 = at("2024-01-01 10:00"), at("2024-01-01 11:00")
    rows = [
        (1, None, "s", "page_view", t1, None, None),
        (2, None, "s", "page_view", t2, None, None),
        (3, None, "s", "page_view", t2, None, None),  # equal times: the larger id stays
        (4, 7, "s", "page_view", t1, None, None),
    ]
    events = frame(rows, EVENTS)
    assert sorted(by(op.dedup_latest(events), "event_id")) == [3, 4]
    audit = op.duplicate_audit(events).collect()
    assert len(audit) == 1 and audit[0]["duplicate_count"] == 3
    assert audit[0]["time_span"] == timedelta(hours=1)


def test_emails(frame):
    emails = ["Ann@Mail.com", "ann+x@mail.com", "ann+x+y@MAIL.com", "bob@mail.com"]
    users = frame(list(enumerate(emails)), "user_id bigint, email string")
    out = by(op.email_variants(users), "user_id")
    assert [out[i]["normalised_email"] for i in range(4)] == ["ann@mail.com"] * 3 + ["bob@mail.com"]
    assert [out[i]["variants_count"] for i in range(4)] == [3, 3, 3, 1]


def test_constraints(frame):
    users = frame(
        [(1, "a@x", None, "free"), (2, "a@x", "n", "gold"), (3, "a@x", "n", None)],
        "user_id bigint, email string, name string, plan string",
    )
    orders = frame(
        [(1, 1, d("101")), (2, 9, d("100")), (3, 9, None), (4, None, d("-1"))],
        "order_id bigint, user_id bigint, discount_pct decimal(5,2)",
    )
    rules = [
        Unique("users", "email"),
        Check("users", "name not null", "name IS NOT NULL"),
        Check("users", "plan allowed", "plan IN ('free', 'pro')"),
        Check("orders", "discount range", "discount_pct BETWEEN 0 AND 100"),
        ForeignKey("orders", "user_id", "users", "user_id"),
    ]
    report = by(op.check_constraints({"users": users, "orders": orders}, rules), "rule")
    assert {k: v["violations"] for k, v in report.items()} == {
        "email unique": 2,
        "name not null": 1,
        "plan allowed": 1,
        "discount range": 2,
        "user_id in users": 2,
    }


def test_lookups(frame):
    users = frame(
        [(1, "u1", "e1", "pro", "IN", at("2024-06-01")), (2, "u2", "e2", "free", "US", at("2020-01-01"))],
        "user_id bigint, name string, email string, plan string, country string, "
        "created_at timestamp_ntz",
    )
    rows = [(i, 1, at("2024-01-15"), d(i)) for i in range(1, 5)]
    revenue = frame(rows, REVENUE)
    top = op.lateral_top_n(users, revenue).collect()
    assert sorted((r["order_id"], r["revenue_rank"]) for r in top) == [(3, 2), (4, 1)]
    for counts in (op.orders_per_user, op.orders_per_user_correlated):
        assert {k: v["order_count"] for k, v in by(counts(users, revenue), "user_id").items()} == {
            1: 4, 2: 0,
        }
    recent = op.country_revenue(users, revenue, as_of=F.lit(at("2024-06-30"))).collect()
    assert [(r["country"], r["orders"], r["revenue"]) for r in recent] == [("IN", 4, 10)]
    assert op.rows_on_day(revenue, date(2024, 1, 15)).count() == 4
    assert op.rows_on_day(revenue, date(2024, 1, 14)).count() == 0
    either = (F.col("user_id") == 1, F.col("plan") == "free")
    assert op.union_or(users.union(users), *either).count() == 2
    assert op.matching_either(users.union(users), *either).count() == 4
    assert op.has_rows(users, F.col("user_id") == 1).first()["has_events"] is True
    assert op.has_rows(users, F.col("user_id") == 9).first()["has_events"] is False


def test_pages(spark, frame):
    df = spark.range(100).select((F.col("id") * 2).alias("v"), "id")
    assert [r["id"] for r in op.keyset_page(df, "id", 40, size=3).collect()] == [41, 42, 43]
    far = op.offset_page(df, "id", 90, size=20)
    assert far.columns == ["v", "id"]
    assert [r["id"] for r in far.collect()] == list(range(90, 100))
    keys = frame([(None, "a"), (1, "c"), (1, "b"), (2, "d"), (3, None)], "id int, v string")
    pages = [op.offset_page(keys, "id", n, size=3).collect() for n in (0, 1, 3, 5)]
    assert [tuple(r) for r in pages[0]] == [(None, "a"), (1, "b"), (1, "c")]
    assert [tuple(r) for r in pages[1]] == [(1, "b"), (1, "c"), (2, "d")]
    assert [tuple(r) for r in pages[2]] == [(2, "d"), (3, None)] and pages[3] == []


@pytest.mark.parametrize("n", [3, 5])
def test_funnels_of_any_length(frame, n):
    steps = ["a", "b", "c", "d", "e"][:n]
    rows = [(f"s{i}", steps[k], "x") for i in range(n) for k in range(i + 1)]
    events = frame(rows, "session_id string, event_type string, device_type string")
    whole = op.funnel(events, steps=steps).first()
    assert whole[:n] == tuple(range(n, 0, -1))
    assert whole["a_to_b_pct"] == round(100 * (n - 1) / n, 1)
    assert whole["overall_conversion_pct"] == round(100 / n, 2)
    drop = op.funnel_dropoff(events, steps=steps).collect()
    assert [r["step"] for r in drop] == [f"{i}. {s}" for i, s in enumerate(steps, 1)]
    assert [r["dropped_off"] for r in drop] == [1] * (n - 1) + [0]
    named = op.funnel_dropoff(events, steps=steps, labels=[s.upper() for s in steps]).collect()
    assert [r["step"] for r in named] == [s.upper() for s in steps]
    split = op.funnel_by_segment(events, steps=steps).first()
    assert (split["device"], split["sessions"], split["a"], split[steps[-1]]) == ("x", n, n, 1)


def test_columns_with_other_names(frame):
    rows = [(1, 1, at("2024-01-05"), d(10)), (2, 1, at("2024-02-05"), d(20)), (3, 2, at("2024-02-06"), d(5))]
    revenue = frame(rows, REVENUE)
    names = {"user_id": "customer", "order_date": "placed", "net_revenue": "amount"}
    own = revenue.withColumnsRenamed({a: b for a, b in names.items()})
    own = own.withColumn("user_id", F.lit("not meant"))
    for operator in (op.cohort_retention, op.running_metrics, op.period_growth, op.first_last_compare):
        expected = operator(revenue)
        found = operator(own, columns=names)
        assert found.columns == expected.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_rank_has_one_type(frame):
    rows = frame([(i % 2, i) for i in range(20)], "k int, v int")
    few, many = (
        op.top_n_per_group(rows, ["k"], [F.col("v").asc()], n, rank="r") for n in (1000, 1001)
    )
    assert few.schema["r"].dataType == many.schema["r"].dataType
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_ltv_counts_customers_without_a_total(frame):
    users = frame([(1, "pro", "x"), (2, "pro", "x"), (3, "free", None)], "user_id int, plan string, acquired_channel string")
    revenue = frame(
        [(1, 1, at("2024-01-01"), d(10)), (2, 2, at("2024-01-01"), None), (3, 3, at("2024-01-01"), None)],
        REVENUE,
    )
    out = by(op.ltv_by_segment(users, revenue, as_of=F.lit("2024-02-01").cast("timestamp_ntz")), "plan")
    assert out["pro"]["customer_count"] == 2 and out["pro"]["avg_total_revenue"] == 5.0
    assert out["free"]["customer_count"] == 1 and out["free"]["top10pct_revenue_share_pct"] is None


def test_growth_classes_are_parameters(frame):
    rows = [(1, 1, at("2024-01-01"), d(100)), (2, 1, at("2024-02-01"), d(150)), (3, 1, at("2024-03-01"), None)]
    revenue = frame(rows, REVENUE)
    by_month = by(op.period_growth(revenue), "month")
    assert by_month[date(2024, 2, 1)]["growth_category"] == "strong_growth"
    assert by_month[date(2024, 3, 1)]["growth_category"] == "significant_decline"
    own = by(op.period_growth(revenue, above=[("doubled", d(2))], at_least=[("kept", d(1))]), "month")
    assert own[date(2024, 2, 1)]["growth_category"] == "kept"


def test_hierarchy_of_any_depth(frame):
    rows = [(i, f"n{i}", i - 1 if i else None) for i in range(30)] + [(50, "a", 51), (51, "b", 50), (60, "c", 50)]
    staff = frame(rows, "emp_id int, name string, manager_id int")
    deep = op.traverse_hierarchy(staff, max_depth=None)
    assert sorted((r["emp_id"], r["depth"]) for r in deep.collect()) == [(i, i + 1) for i in range(30)]
    assert op.traverse_hierarchy(staff).count() == 10


def test_windows_do_not_depend_on_the_session_zone(spark, tables):
    def both():
        revenue = op.order_revenue(tables["placed_orders"], tables["order_items"], tables["products"])
        start, end = datetime(1996, 1, 1), datetime(1998, 6, 30)
        cohorts = op.cohort_retention_range(revenue, start, end, max_period=3, wide=False)
        funnel = op.funnel_metrics(tables["events"], datetime(2024, 1, 3), datetime(2024, 1, 20))
        return sorted(map(tuple, cohorts.collect())), funnel.collect()

    here = both()
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert both() == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_revenue_summary(frame):
    rows = [
        (1, 1, at("2024-01-31"), d(10), d(4)),
        (2, 1, at("2024-02-01"), d(20), d(5)),
        (3, 2, at("2024-02-29"), d(5), d(1)),
    ]
    revenue = frame(rows, REVENUE + ", gross_profit decimal(12,2)")
    out = by(op.revenue_summary(revenue), "period")
    february = out[date(2024, 2, 1)]
    assert february["unique_customers"] == 2 and february["avg_order_value"] == 12.5
    assert february["gross_margin_pct"] == 24.0 and february["revenue_mom_pct"] == 150.0
    assert out[date(2024, 1, 1)]["revenue_mom_pct"] is None
    assert [r["period"] for r in op.revenue_summary(revenue, "week").orderBy("period").collect()] == [
        date(2024, 1, 29),
        date(2024, 2, 26),
    ]
    with pytest.raises(ValueError):
        op.revenue_summary(revenue, "hour")
    with pytest.raises(ValueError):
        period_of(F.lit(None), "decade")


def test_analytics_facade(spark, tables):
    facade = Analytics(spark, tables)
    facade.pin_revenue()
    assert facade.cohort_retention("1996-01-01", max_period=3).columns == [
        "cohort_month", "M0", "M1", "M2", "M3",
    ]
    total = facade.revenue_summary("year").agg(F.sum("total_orders")).first()[0]
    assert total == facade.revenue.count()
    assert facade.funnel_metrics("2024-01-01", "2024-02-01", "referrer").count() == 5
    spark.range(3).createOrReplaceTempView("events")  # a view of the caller's own
    counter = spark.sparkContext.accumulator(0)
    counted = facade.process_in_chunks(
        "SELECT event_id FROM events WHERE event_type = :kind",
        lambda chunk: chunk.agg(["count"]).rename(columns={"event_id": "n"}),
        "n bigint",
        params={"kind": "purchase"},
        chunk_size=100,
        counter=counter,
    )
    assert spark.table("events").count() == 3
    spark.catalog.dropTempView("events")
    expected = tables["events"].filter("event_type = 'purchase'").count()
    assert counted.agg(F.sum("n")).first()[0] == expected == counter.value
