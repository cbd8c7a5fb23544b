"""Ranking, growth, running and first/last comparisons."""

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.fixed_values import (
    GROWTH_ABOVE,
    GROWTH_AT_LEAST,
    GROWTH_FIRST,
    GROWTH_REST,
    RANK_BUCKETS,
)
from tallywork.functions import any_names, average, day_of, month_of, ntile_of, percent, period_of
from tallywork.plans import durable, global_ranks, join_null_safe, order_rows, row_numbers

# Spark limits each group before the shuffle for ranks up to this (its default threshold)
GROUP_LIMIT = 1000


@any_names
def rank_orders(revenue: DataFrame, *, buckets: int = RANK_BUCKETS) -> DataFrame:
    """Rank every order by revenue, overall and in its month, and split them into buckets."""
    rows = revenue.select(
        "user_id",
        "order_id",
        "order_date",
        "net_revenue",
        month_of(F.col("order_date")).alias("month"),
    )
    ranked = global_ranks(rows, "net_revenue", "order_id", within="month")
    return ranked.select(
        "user_id",
        "order_id",
        day_of(F.col("order_date")).alias("order_date"),
        "net_revenue",
        F.col("row_number").alias("rn_overall"),
        F.col("rank").alias("rank_overall"),
        F.col("dense_rank").alias("dense_rank_overall"),
        F.col("row_number_within").alias("rn_within_month"),
        ntile_of(F.col("row_number"), F.col("total"), buckets).alias("percentile_bucket"),
    )


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, *, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of every group with their number, a bigint.

    Each task keeps only its own first ``n`` rows of a group before the shuffle, so a group of any
    size sends few rows. Larger ``n`` takes the distributed row number.
    """
    if n > GROUP_LIMIT:
        return row_numbers(df, keys, order, rank).filter(F.col(rank) <= n)
    window = Window.partitionBy(*keys).orderBy(*order)
    first = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
    return first.withColumn(rank, F.col(rank).cast("bigint"))


@any_names
def period_growth(
    revenue: DataFrame,
    *,
    granularity: str = "month",
    above: Sequence[tuple[str, Decimal]] = GROWTH_ABOVE,
    at_least: Sequence[tuple[str, Decimal]] = GROWTH_AT_LEAST,
) -> DataFrame:
    """Revenue per user and month with the neighbouring active months and a growth class.

    ``months_since_first_order`` counts the user's active months, not calendar months. ``above`` and
    ``at_least`` are the classes in turn, with the factor of the previous month's revenue that the
    month must be above or at; what meets none is in the last class.
    """
    period = period_of(F.col("order_date"), granularity)
    monthly = revenue.groupBy("user_id", period.alias("month")).agg(
        F.sum("net_revenue").cast("decimal(30,6)").alias("monthly_revenue")
    )
    active = Window.partitionBy("user_id").orderBy("month")  # at most one row per calendar month
    now, previous = F.col("monthly_revenue"), F.col("prev_month_revenue")
    growth = F.when(previous.isNull(), GROWTH_FIRST)
    for label, factor in above:
        growth = growth.when(now > previous * F.lit(factor), label)
    for label, factor in at_least:
        growth = growth.when(now >= previous * F.lit(factor), label)
    return (
        monthly.withColumn("prev_month_revenue", F.lag("monthly_revenue").over(active))
        .withColumn("next_month_revenue", F.lead("monthly_revenue").over(active))
        .withColumn("months_since_first_order", (F.row_number().over(active) - 1).cast("bigint"))
        .withColumn("mom_growth_pct", percent(now - previous, previous))
        .withColumn("growth_category", growth.otherwise(GROWTH_REST))
    )


@any_names
def running_metrics(revenue: DataFrame) -> DataFrame:
    """Daily revenue with running total, moving mean and maximum, and share of the whole.

    The frames count rows, that is days with orders. The windows see one row per day.
    """
    daily = revenue.groupBy(day_of(F.col("order_date")).alias("day")).agg(
        F.sum("net_revenue").cast("decimal(34,6)").alias("daily_rev")
    )
    by_day = Window.orderBy("day")
    whole = Window.partitionBy()
    value = F.col("daily_rev")

    def mean(frame) -> Column:
        return average(F.sum(value).over(frame), F.count(value).over(frame), 2)

    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    week, month = by_day.rowsBetween(-6, 0), by_day.rowsBetween(-29, 0)
    return daily.select(
        "day",
        value,
        F.sum(value).over(so_far).alias("cumulative_revenue"),
        mean(week).alias("ma_7d"),
        mean(month).alias("ma_30d"),
        F.max(value).over(week).alias("max_7d"),
        mean(so_far).alias("expanding_avg"),
        percent(value, F.sum(value).over(whole), 2).alias("pct_of_total_revenue"),
    )


@any_names
def first_last_compare(revenue: DataFrame, *, slices: int | None = None) -> DataFrame:
    """Every order next to the first and the latest order of its user.

    Both ends of a user come from partial aggregates and are joined back; ``slices``: see
    ``order_rows``. The rows are read several times, so they are stored first.
    """
    rows = durable(revenue.select("user_id", "order_id", "order_date", "net_revenue"), "orders")
    order = ("order_date", "order_id")
    numbered = order_rows(rows, "user_id", order, slices=slices).with_row_number("order_number")
    ends = rows.groupBy("user_id").agg(
        F.min_by(F.struct("net_revenue", "order_date"), F.struct(*order)).alias("_first"),
        F.max_by("net_revenue", F.struct(*order)).alias("latest_order_revenue"),
    )
    compared = join_null_safe(numbered.rows(), ends, ["user_id"])
    first = F.col("_first.net_revenue")
    return compared.select(
        "user_id",
        "order_id",
        day_of(F.col("order_date")).alias("order_date"),
        "net_revenue",
        first.alias("first_order_revenue"),
        day_of(F.col("_first.order_date")).alias("first_order_date"),
        "latest_order_revenue",
        percent(F.col("net_revenue") - first, first).alias("pct_change_vs_first_order"),
        F.col("order_number").cast("bigint").alias("order_number"),
    )


def nth_per_group(
    df: DataFrame, key: str, order: Sequence[str], n: int, value: str, *, out: str = "nth_value"
) -> DataFrame:
    """Add the ``value`` of the ``n``-th row of each group to all its rows; NULL in smaller groups.

    ``order`` ends with a unique column. Each task sends the first ``n`` rows of a group only; the
    n-th ones are joined back.
    """
    columns = [F.col(c).asc() for c in order]
    numbered = top_n_per_group(
        df.select(key, *order, F.col(value).alias("_value")), [key], columns, n, rank="_rank"
    )
    nth = numbered.filter(F.col("_rank") == n).select(key, F.col("_value").alias(out))
    return join_null_safe(df, nth, [key], how="left")
