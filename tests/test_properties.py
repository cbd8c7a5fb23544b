"""Relations that hold between and inside the results."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywork import operators as op


def test_retention_starts_at_all(revenue):
    first = op.cohort_retention(revenue).filter("period = 0")
    assert first.filter("retention_pct <> 100 OR active_users <> cohort_size").count() == 0
    members = first.agg(F.sum("cohort_size")).first()[0]
    assert members == revenue.select("user_id").distinct().count()


def test_running_total_ends_at_the_whole(revenue):
    daily = op.running_metrics(revenue)
    last = daily.orderBy(F.col("day").desc()).first()["cumulative_revenue"]
    assert last == revenue.agg(F.sum("net_revenue")).first()[0]


def test_cohort_revenue_adds_up(revenue):
    total = op.cohort_revenue(revenue).agg(F.sum("cohort_revenue")).first()[0]
    assert abs(total - revenue.agg(F.sum("net_revenue")).first()[0]) < 100


def test_movements_add_up(tables):
    out = op.mrr_movements(tables["subscriptions"])
    kinds = ["new_mrr", "expansion_mrr", "reactivation_mrr", "contraction_mrr", "churn_mrr"]
    parts = sum((F.coalesce(F.col(k), F.lit(0)) for k in kinds), F.lit(0))
    assert out.filter(parts != F.col("net_new_mrr")).count() == 0


def test_movement_variants_differ_in_named_columns_only(tables):
    intended = op.mrr_movements(tables["subscriptions"])
    literal = op.mrr_movements(tables["subscriptions"], literal=True)
    moved = {"expansion_mrr", "reactivation_mrr", "expanded_customers"}
    columns = [c for c in intended.columns if c not in moved]
    assert intended.select(*columns).exceptAll(literal.select(*columns)).count() == 0
    assert literal.filter("reactivation_mrr IS NOT NULL").count() == 0


def test_spine_has_every_day(tables, revenue):
    out = op.gap_fill(tables["placed_orders"], revenue)
    span = tables["placed_orders"].agg(F.datediff(F.max("order_date"), F.min("order_date")))
    assert out.count() == span.first()[0] + 1 == out.select("day").distinct().count()
    assert out.agg(F.sum("revenue")).first()[0] == revenue.agg(F.sum("net_revenue")).first()[0]


def test_dedup_leaves_unique_keys(tables):
    keys = ["user_id", "session_id", "event_type"]
    out = op.dedup_latest(tables["events"])
    assert out.count() == out.select(*keys).distinct().count()
    audit = op.duplicate_audit(tables["events"])
    removed = audit.agg(F.sum(F.col("duplicate_count") - 1)).first()[0]
    assert out.count() + removed == tables["events"].count()


def test_sessions_hold_every_known_event(tables):
    events = tables["events"].filter("user_id IS NOT NULL")
    out = op.sessionize(tables["events"])
    assert out.agg(F.sum("events_in_session")).first()[0] == events.count()
    by_user = Window.partitionBy("user_id").orderBy("session_num")
    gaps = out.withColumn("before", F.lag("session_end").over(by_user))
    close = F.col("session_start") <= F.col("before") + F.expr("interval 30 minutes")
    assert gaps.filter(close).count() == 0


def test_sessions_agree_with_session_windows(tables):
    known = tables["events"].filter("user_id IS NOT NULL")
    windows = known.groupBy("user_id", F.session_window("event_at", "30 minutes")).count()
    assert windows.count() == op.sessionize(tables["events"]).count()


def test_segments_cover_all_sessions(tables):
    sessions = tables["events"].select("session_id").distinct().count()
    by_device = op.funnel_by_segment(tables["events"])
    assert by_device.agg(F.sum("sessions")).first()[0] == sessions


def test_summaries_agree_at_every_granularity(revenue):
    totals = {
        g: op.revenue_summary(revenue, g).agg(F.sum("total_orders")).first()[0]
        for g in ("day", "week", "month", "quarter", "year")
    }
    assert set(totals.values()) == {revenue.count()}
