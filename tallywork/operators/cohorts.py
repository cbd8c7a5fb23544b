"""Cohort retention and cohort revenue."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.fixed_values import RETENTION_PERIODS
from tallywork.functions import any_names, average, moment, month_of, months_apart, percent


def _first_per_user(column: str) -> Column:
    return F.min(column).over(Window.partitionBy("user_id"))  # one row per user and month


def _user_months(revenue: DataFrame, *more: Column) -> DataFrame:
    month = month_of(F.col("order_date")).alias("month")
    if more:
        return revenue.groupBy("user_id", month).agg(*more)
    return revenue.select("user_id", month).distinct()


def _with_period(user_months: DataFrame) -> DataFrame:
    """Tag each user-month with the user's first month and the months since then."""
    first = _first_per_user("month")
    return user_months.withColumn("cohort_month", first).withColumn(
        "period", months_apart(F.col("month"), F.col("cohort_month"))
    )


def _retention(tagged: DataFrame) -> DataFrame:
    active = tagged.groupBy("cohort_month", "period").agg(
        F.count(F.lit(1)).alias("active_users")
    )
    # few rows: one per cohort and period
    size = F.max(F.when(F.col("period") == 0, F.col("active_users"))).over(
        Window.partitionBy("cohort_month")
    )
    return active.select(
        "cohort_month",
        size.alias("cohort_size"),
        "period",
        "active_users",
        percent(F.col("active_users"), size).alias("retention_pct"),
    )


@any_names
def cohort_retention(revenue: DataFrame) -> DataFrame:
    """Active users per first-order month and months since, with the share that came back."""
    return _retention(_with_period(_user_months(revenue)))


@any_names
def cohort_retention_wide(
    revenue: DataFrame, *, periods: Sequence[int] = RETENTION_PERIODS
) -> DataFrame:
    """Retention with one column per period: ``m0_pct``, ``m1_pct``, ..."""
    long = cohort_retention(revenue)
    columns = [
        F.max(F.when(F.col("period") == p, F.col("retention_pct"))).alias(f"m{p}_pct")
        for p in periods
    ]
    return long.groupBy("cohort_month", "cohort_size").agg(*columns)


@any_names
def cohort_revenue(revenue: DataFrame) -> DataFrame:
    """Revenue per cohort and period, per member and against the first month."""
    user_months = _user_months(
        revenue,
        F.sum("net_revenue").alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
    )
    totals = (
        _with_period(user_months)
        .groupBy("cohort_month", "period")
        .agg(
            F.count(F.lit(1)).alias("active_users"),
            F.sum("revenue").alias("revenue"),
            F.sum("orders").alias("orders"),
        )
    )
    cohort = Window.partitionBy("cohort_month")
    so_far = cohort.orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_start = F.col("period") == 0
    size = F.max(F.when(at_start, F.col("active_users"))).over(cohort)
    base = F.max(F.when(at_start, F.col("revenue"))).over(cohort)
    money = F.col("revenue")
    return totals.select(
        "cohort_month",
        size.alias("cohort_size"),
        "period",
        "active_users",
        F.round(money, 2).alias("cohort_revenue"),
        average(money, F.col("orders"), 2).alias("avg_order_value"),
        average(money, F.col("active_users"), 2).alias("revenue_per_active_user"),
        average(F.sum(money).over(so_far), size, 2).alias("cumulative_ltv_per_user"),
        percent(money, base).alias("revenue_retention_pct"),
    )


@any_names
def cohort_retention_range(
    revenue: DataFrame,
    start,
    end=None,
    *,
    max_period: int = 12,
    wide: bool = True,
) -> DataFrame:
    """Retention of users whose first order in ``[start, end]`` sets the cohort.

    Orders before the window do not count towards the cohort; orders after ``end`` count as
    activity. ``wide`` gives one column per period, ``M0`` to ``M<max_period>``.
    """
    kind = revenue.schema["order_date"].dataType
    start = moment(start, kind)
    # orders before the first cohort or after the last period cannot change the result
    wanted = F.col("order_date") >= F.date_trunc("month", start).cast(kind)
    inside = F.col("order_date") >= start
    if end is not None:
        end = moment(end, kind)
        inside = inside & (F.col("order_date") <= end)
        beyond = F.add_months(F.trunc(F.to_date(end), "month"), max_period + 1)
        wanted = wanted & (F.col("order_date") < beyond.cast(kind))
    revenue = revenue.filter(wanted)
    joined = F.min(F.when(inside, F.col("order_date"))).alias("first_inside")
    cohort = month_of(_first_per_user("first_inside"))
    tagged = (
        _user_months(revenue, joined)
        .withColumn("cohort_month", cohort)
        .filter(F.col("month") >= F.col("cohort_month"))
        .withColumn("period", months_apart(F.col("month"), F.col("cohort_month")))
        .filter(F.col("period") <= max_period)
    )
    long = _retention(tagged)
    if not wide:
        return long
    pivoted = long.groupBy("cohort_month").pivot("period", list(range(max_period + 1)))
    table = pivoted.agg(F.first("retention_pct"))
    return table.select("cohort_month", *(F.col(str(p)).alias(f"M{p}") for p in range(max_period + 1)))
