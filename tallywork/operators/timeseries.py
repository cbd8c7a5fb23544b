"""Dense day series, period comparison, rolling activity and sessions."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.fixed_values import SESSION_GAP_MINUTES
from tallywork.functions import (
    any_names,
    average,
    day_of,
    half_up,
    minutes,
    percent,
    period_of,
    ratio,
)
from tallywork.plans import order_rows

_STEPS = {"day": "1 day", "week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}


def _days(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("day")


def _daily(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy(day_of(F.col("order_date")).alias("day")).agg(
        F.sum("net_revenue").alias("revenue"), F.count("order_id").alias("orders")
    )


@any_names
def gap_fill(orders: DataFrame, revenue: DataFrame, *, literal: bool = False) -> DataFrame:
    """Revenue for every day from the first to the last order, with the last known value carried.

    ``literal`` takes the plain last row instead of the last known value, so gaps stay NULL.
    """
    day = day_of(F.col("order_date"))
    spine = orders.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    filled = spine.select(_days(F.col("a"), F.col("b"))).join(_daily(revenue), "day", "left")
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.last("revenue", ignorenulls=not literal).over(so_far)
    return filled.select(
        "day",
        F.coalesce("revenue", F.lit(0)).alias("revenue"),
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce(F.col("revenue"), carried).alias("revenue_ffill"),
    )


@any_names
def date_spine_fill(revenue: DataFrame, *, as_of: Column) -> DataFrame:
    """Revenue and orders for every day from the first revenue to ``as_of``; empty days flagged.

    A first day after ``as_of`` still gives that one day.
    """
    by_day = Window.orderBy("day")  # one row per day
    now = day_of(as_of)
    before_next = F.date_sub(F.lead("day").over(by_day), 1)
    until = F.coalesce(before_next, F.greatest(F.col("day"), now))
    daily = _daily(revenue).withColumn("start", F.first("day").over(by_day))
    dense = _spread(daily, "day", until, "interval 1 day", ["revenue", "orders"])
    return dense.filter((F.col("day") <= now) | (F.col("day") == F.col("start"))).select(
        "day",
        F.coalesce("revenue", F.lit(0)).alias("daily_revenue"),
        F.coalesce("orders", F.lit(0)).alias("order_count"),
        F.col("revenue").isNull().alias("is_zero_day"),
    )


def _spread(
    rows: DataFrame, column: str, until: Column, step: str, values: Sequence[str]
) -> DataFrame:
    """Follow every row by rows for the steps of ``column`` up to ``until``, with NULL ``values``.

    Fills a series from the series itself, without computing it a second time for a spine.
    """
    kept = [c for c in rows.columns if c != column and c not in values]
    steps = F.explode(F.sequence(F.col(column), F.col("_until"), F.expr(step))).alias("_step")
    spread = rows.withColumn("_until", until).select("*", steps)
    own = F.col("_step") == F.col(column)
    return spread.select(
        F.col("_step").alias(column), *kept, *(F.when(own, F.col(v)).alias(v) for v in values)
    )


@any_names
def period_over_period(
    revenue: DataFrame, *, granularity: str = "month", back: int = 12, dense: bool = False
) -> DataFrame:
    """Revenue per period against the previous row and the row ``back`` rows before.

    Periods without orders have no row, so ``back`` counts active periods; ``dense`` adds them
    with revenue 0.
    """
    period = period_of(F.col("order_date"), granularity)
    totals = revenue.groupBy(period.alias("month")).agg(F.sum("net_revenue").alias("revenue"))
    by_period = Window.orderBy("month")  # one row per period
    if dense:
        step = f"interval {_STEPS[granularity]}"
        before_next = (F.lead("month").over(by_period) - F.expr(step)).cast("date")
        until = F.coalesce(before_next, F.col("month"))
        totals = _spread(totals, "month", until, step, ["revenue"])
        totals = totals.select("month", F.coalesce("revenue", F.lit(0)).alias("revenue"))
    three = by_period.rowsBetween(-2, 0)
    now = F.col("revenue")
    previous, year_ago = F.lag(now, 1).over(by_period), F.lag(now, back).over(by_period)
    return totals.select(
        "month",
        "revenue",
        previous.alias("prev_month"),
        percent(now - previous, previous).alias("mom_pct"),
        year_ago.alias("same_month_last_year"),
        percent(now - year_ago, year_ago).alias("yoy_pct"),
        average(F.sum(now).over(three), F.count(now).over(three), 0).alias("ma_3mo"),
    )


@any_names
def rolling_activity(revenue: DataFrame) -> DataFrame:
    """Daily active users, their sums over 7 and 30 rows and the ratio to the 30-row mean."""
    daily = revenue.groupBy(day_of(F.col("order_date")).alias("day")).agg(
        F.count_distinct("user_id").alias("dau")
    )
    by_day = Window.orderBy("day")  # one row per day
    week, month = by_day.rowsBetween(-6, 0), by_day.rowsBetween(-29, 0)
    dau = F.col("dau")
    mean = ratio(F.sum(dau).over(month), F.count(dau).over(month))
    return daily.select(
        "day",
        "dau",
        F.sum(dau).over(week).alias("rolling_7d_activity"),
        F.sum(dau).over(month).alias("rolling_30d_activity"),
        half_up(ratio(F.lit(100.0) * dau, mean), 1).alias("dau_to_avg_ratio_pct"),
    )


@any_names
def sessionize(
    events: DataFrame,
    *,
    gap_minutes: int = SESSION_GAP_MINUTES,
    goal: str = "purchase",
    slices: int | None = None,
) -> DataFrame:
    """Number the sessions of every known user; a gap longer than ``gap_minutes`` starts a new one.

    ``slices``: see ``order_rows``.
    """
    rows = events.filter(F.col("user_id").isNotNull()).select(
        "user_id", "event_id", "event_at", "event_type"
    )
    gap = F.make_dt_interval(mins=F.lit(gap_minutes))
    starts = F.coalesce(F.col("event_at") > F.col("previous_at") + gap, F.lit(True))
    ordered = order_rows(rows, "user_id", ("event_at", "event_id"), slices=slices)
    ordered = ordered.with_previous("event_at", "previous_at")
    ordered = ordered.with_column("starts", starts.cast("int"))
    numbered = ordered.with_running_sum("starts", "session_num").rows()
    first, last = F.min("event_at"), F.max("event_at")
    return numbered.groupBy("user_id", "session_num").agg(
        F.count(F.lit(1)).alias("events_in_session"),
        first.alias("session_start"),
        last.alias("session_end"),
        half_up(minutes(F.timestamp_diff("MICROSECOND", first, last)), 1).alias("duration_min"),
        F.bool_or(F.col("event_type") == goal).alias("converted"),
    )
