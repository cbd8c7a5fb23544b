"""Lookups, per-user counts and pages."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.fixed_values import PAGE_SIZE, RECENT_DAYS
from tallywork.functions import any_names, day_of
from tallywork.operators.windows import top_n_per_group
from tallywork.plans import rows_by_rank


@any_names
def lateral_top_n(users: DataFrame, revenue: DataFrame, *, n: int = 2) -> DataFrame:
    """The ``n`` orders with the most revenue of each user; users without orders drop out.

    Ranking first leaves at most ``n`` rows per user for the join.
    """
    orders = revenue.select("user_id", "order_id", "order_date", "net_revenue")
    best_first = [F.col("net_revenue").desc(), F.col("order_id").asc()]
    top = top_n_per_group(orders, ["user_id"], best_first, n, rank="revenue_rank")
    return users.join(top, "user_id").select(
        "user_id",
        "email",
        "plan",
        "order_id",
        day_of(F.col("order_date")).alias("order_date"),
        "net_revenue",
        F.col("revenue_rank").cast("bigint").alias("revenue_rank"),
    )


@any_names
def country_revenue(
    users: DataFrame, revenue: DataFrame, *, as_of: Column, days: int = RECENT_DAYS
) -> DataFrame:
    """Orders and revenue per country of the users created in the last ``days`` days.

    The orders meet the recent users first, so only theirs are summed; Spark broadcasts the users
    below its size threshold and otherwise splits the partition of a user with very many orders.
    """
    recent = users.filter(F.col("created_at") > as_of - F.make_dt_interval(F.lit(days)))
    theirs = revenue.select("user_id", "net_revenue").join(
        recent.select("user_id", "country"), "user_id"
    )
    return theirs.groupBy("country").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("net_revenue").alias("revenue")
    )


@any_names
def orders_per_user(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders per user, 0 included. Orders are counted before the join."""
    counts = orders.groupBy("user_id").agg(F.count("order_id").alias("order_count"))
    return users.join(counts, "user_id", "left").select(
        "user_id", "name", F.coalesce("order_count", F.lit(0)).alias("order_count")
    )


@any_names
def orders_per_user_correlated(users: DataFrame, orders: DataFrame) -> DataFrame:
    """The same as a scalar subquery per user, which Spark rewrites to an outer join."""
    u, o = users.alias("u"), orders.alias("o")
    mine = o.where(F.col("o.user_id") == F.col("u.user_id").outer())
    return u.select("user_id", "name", mine.select(F.count(F.lit(1))).scalar().alias("order_count"))


def rows_on_day(df: DataFrame, day: date, *, time: str = "order_date") -> DataFrame:
    """Rows of one day as a half-open range, which the scan can push down."""
    return df.filter((F.col(time) >= F.lit(day)) & (F.col(time) < F.lit(day + timedelta(days=1))))


def matching_either(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Rows that meet either condition, in one scan."""
    return df.filter(a | b)


def union_or(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """The distinct union of the rows that meet ``a`` and those that meet ``b``, in one scan."""
    return df.filter(a | b).distinct()


def has_rows(df: DataFrame, condition: Column, *, out: str = "has_events") -> DataFrame:
    """One row: does any row meet the condition? Each task stops at its first match."""
    return df.filter(condition).limit(1).agg((F.count(F.lit(1)) > 0).alias(out))


def keyset_page(df: DataFrame, key: str, after, *, size: int = PAGE_SIZE) -> DataFrame:
    """The next ``size`` rows after the unique key value ``after``."""
    return df.filter(F.col(key) > F.lit(after)).orderBy(F.col(key).asc()).limit(size)


def offset_page(df: DataFrame, key: str, offset: int, *, size: int = PAGE_SIZE) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + size`` by ``key``, NULLs first.

    Rows with equal keys go by the other columns. The page is found by counting: no task holds the rows
    before a far page, nothing but a small sample is stored for a moment, and only the part of the
    table with the page is sorted.
    """
    return rows_by_rank(df, [key, *(c for c in df.columns if c != key)], offset, size)
