"""The history of each user over raw rows; a user may hold any share of them."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.fixed_values import USER_BUCKETS, USER_FRAMES
from tallywork.functions import any_names, average, half_up, minutes, ntile_of, percent
from tallywork.plans import (
    ALL,
    Frame,
    durable,
    first_of_key,
    following,
    keyed_frames,
    keyed_ranks,
    last_known,
    last_of_key,
    order_rows,
)


@any_names
def user_moving_metrics(
    revenue: DataFrame, *, lengths: Sequence[int] = USER_FRAMES, slices: int | None = None
) -> DataFrame:
    """Every order with totals and means over the user's orders so far and over the last ones.

    ``ma_n`` and ``max_n`` take the order and the ``n - 1`` before it, for every ``n`` of ``lengths``.
    ``slices``: see ``keyed_frames``.
    """
    # read several times: to find where users are cut, for their states and for the rows
    rows = durable(revenue.select("user_id", "order_id", "order_date", "net_revenue"), "orders")
    wanted: list[tuple[str, int | str | None]] = [("so_far", None), ("whole", ALL)]
    wanted += [(str(n), n) for n in lengths]
    frames = [Frame(f"_sum_{name}", "sum", "net_revenue", n) for name, n in wanted]
    frames += [Frame(f"_n_{name}", "count", "net_revenue", n) for name, n in wanted if n != ALL]
    frames += [Frame(f"max_{n}", "max", "net_revenue", n) for n in lengths]
    framed = keyed_frames(rows, "user_id", ("order_date", "order_id"), frames, slices=slices)

    def mean(name: str):
        return average(F.col(f"_sum_{name}"), F.col(f"_n_{name}"), 2)

    return framed.select(
        "user_id",
        "order_id",
        "order_date",
        "net_revenue",
        F.col("_sum_so_far").alias("cumulative_revenue"),
        *(mean(str(n)).alias(f"ma_{n}") for n in lengths),
        *(f"max_{n}" for n in lengths),
        mean("so_far").alias("expanding_avg"),
        percent(F.col("net_revenue"), F.col("_sum_whole"), 2).alias("pct_of_user_revenue"),
    )


@any_names
def user_event_fill(
    events: DataFrame, *, goal: str = "purchase", slices: int | None = None
) -> DataFrame:
    """Every event of a known user with the next one, the last ``goal`` so far and the user's both ends.

    ``last_goal_at`` carries the last known time of the goal forward; before the first one it is NULL.
    ``slices``: see ``order_rows``.
    """
    rows = events.filter(F.col("user_id").isNotNull()).select(
        "user_id",
        "event_id",
        "event_at",
        "event_type",
        F.when(F.col("event_type") == goal, F.col("event_at")).alias("_goal_at"),
    )
    order = ("event_at", "event_id")
    filled = order_rows(rows, "user_id", order, slices=slices).with_columns(
        following("event_type", "next_event_type", order),
        following("event_at", "_next_at", order),
        last_known("_goal_at", "last_goal_at", order),
        first_of_key("event_type", "first_event_type", order),
        last_of_key("event_type", "last_event_type", order),
    )
    wait = minutes(F.timestamp_diff("MICROSECOND", "event_at", "_next_at"))
    return filled.rows().select(
        "user_id",
        "event_id",
        "event_at",
        "event_type",
        "next_event_type",
        half_up(wait, 1).alias("minutes_to_next"),
        "last_goal_at",
        "first_event_type",
        "last_event_type",
    )


@any_names
def ranks_per_user(
    revenue: DataFrame, *, buckets: int = USER_BUCKETS, slices: int | None = None
) -> DataFrame:
    """Rank every order by revenue inside its user, largest first, and split the user's orders into buckets.

    ``revenue_with_peers`` and ``orders_with_peers`` run over all orders up to the last one of equal
    revenue. ``slices``: see ``order_rows``.
    """
    rows = revenue.select("user_id", "order_id", "net_revenue", (-F.col("net_revenue")).alias("_down"))
    rows = durable(rows, "orders")  # read several times
    ranked = keyed_ranks(rows, "user_id", "_down", "order_id", measure="net_revenue", slices=slices)
    return ranked.select(
        "user_id",
        "order_id",
        "net_revenue",
        F.col("row_number").alias("rn_in_user"),
        F.col("rank").alias("rank_in_user"),
        F.col("dense_rank").alias("dense_rank_in_user"),
        ntile_of(F.col("row_number"), F.col("total"), buckets).alias("bucket"),
        F.col("peers_sum").alias("revenue_with_peers"),
        F.col("peers_rows").alias("orders_with_peers"),
    )
