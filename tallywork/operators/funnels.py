"""Conversion funnels. A step counts once per session; the order of events is not checked."""

from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.fixed_values import (
    DROPOFF_LABELS,
    FUNNEL_COLUMNS,
    FUNNEL_ENDS,
    FUNNEL_SEGMENTS,
    FUNNEL_SHORT_NAMES,
    FUNNEL_STEPS,
)
from tallywork.functions import any_names, half_up, minutes, moment, percent, ratio
from tallywork.plans import exact_percentiles


def _reached(steps: Sequence[str]) -> list[Column]:
    return [
        F.max((F.col("event_type") == step).cast("int")).alias(f"s{i}")
        for i, step in enumerate(steps, 1)
    ]


def _totals(sessions: DataFrame, steps: Sequence[str], *keys: str) -> DataFrame:
    """Sessions and sessions that reached each step."""
    return sessions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        *(F.sum(f"s{i}").alias(f"s{i}") for i, _ in enumerate(steps, 1)),
    )


def _rates(steps: Sequence[str]) -> list[Column]:
    """Conversion from each step to the next, and from the first to the last."""
    names = FUNNEL_SHORT_NAMES if tuple(steps) == FUNNEL_STEPS else steps
    reached = [F.col(f"s{i}") for i, _ in enumerate(steps, 1)]
    return [
        *(
            percent(after, before).alias(f"{name}_to_{following}_pct")
            for (before, after), (name, following) in zip(
                pairwise(reached), pairwise(names), strict=True
            )
        ),
        percent(reached[-1], reached[0], 2).alias("overall_conversion_pct"),
    ]


@any_names
def funnel(events: DataFrame, *, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """One row: sessions that reached each step, and the conversion from step to step.

    Columns are named after the steps; the default steps have names of their own.
    """
    totals = _totals(events.groupBy("session_id").agg(*_reached(steps)), steps)
    names = FUNNEL_COLUMNS if tuple(steps) == FUNNEL_STEPS else steps
    return totals.select(
        *(F.col(f"s{i}").alias(f"step{i}_{name}") for i, name in enumerate(names, 1)),
        *_rates(steps),
    )


@any_names
def funnel_by_segment(
    events: DataFrame, *, segment: str = "device_type", steps: Sequence[str] = FUNNEL_STEPS
) -> DataFrame:
    """The funnel per most frequent ``segment`` value of a session; ties go to the smallest value.

    Counts and flags are first reduced per session and value, so one pass gives both the mode and
    the steps.
    """
    per_value = events.groupBy("session_id", segment).agg(
        F.count(F.lit(1)).alias("n"), *_reached(steps)
    )
    seen = F.when(F.col(segment).isNotNull(), F.struct((-F.col("n")).alias("n"), F.col(segment)))
    sessions = per_value.groupBy("session_id").agg(
        F.min(seen)[segment].alias("device"),
        *(F.max(f"s{i}").alias(f"s{i}") for i, _ in enumerate(steps, 1)),
    )
    first, last = FUNNEL_ENDS if tuple(steps) == FUNNEL_STEPS else (steps[0], steps[-1])
    return _totals(sessions, steps, "device").select(
        "device",
        "sessions",
        F.col("s1").alias(first),
        F.col(f"s{len(steps)}").alias(last),
        *_rates(steps),
    )


@any_names
def time_to_convert(
    events: DataFrame, *, start: str = FUNNEL_STEPS[0], end: str = FUNNEL_STEPS[-1]
) -> DataFrame:
    """Minutes from the first ``start`` event to the first ``end`` event of a session."""
    kind, at = F.col("event_type"), F.col("event_at")
    sessions = (
        events.filter(kind.isin(start, end))
        .groupBy("session_id")
        .agg(F.min(F.when(kind == start, at)).alias("a"), F.min(F.when(kind == end, at)).alias("b"))
        .filter(F.col("b") >= F.col("a"))
        .select(F.timestamp_diff("MICROSECOND", "a", "b").alias("micros"))
    )
    both = exact_percentiles(
        sessions,
        [],
        "micros",
        {"p50": 0.5, "p90": 0.9},
        also={"n": F.count(F.lit(1)), "micros": F.sum("micros")},
    )
    return both.select(
        F.col("n").alias("converting_sessions"),
        half_up(ratio(minutes(F.col("micros")), F.col("n")), 1).alias("avg_minutes_to_convert"),
        half_up(minutes(F.col("p50")), 1).alias("median_minutes"),
        half_up(minutes(F.col("p90")), 1).alias("p90_minutes"),
    )


@any_names
def funnel_dropoff(
    events: DataFrame,
    *,
    steps: Sequence[str] = FUNNEL_STEPS,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """One row per step: sessions that reached it and those lost before the next step.

    ``labels`` name the rows; other steps than the default ones are numbered by default.
    """
    if labels is None:
        numbered = [f"{i}. {step}" for i, step in enumerate(steps, 1)]
        labels = DROPOFF_LABELS if tuple(steps) == FUNNEL_STEPS else numbered
    totals = _totals(events.groupBy("session_id").agg(*_reached(steps)), steps)
    rows = []
    for i, (_, label) in enumerate(zip(steps, labels, strict=True), 1):
        here = F.col(f"s{i}")
        last = i == len(steps)
        lost = F.lit(0).cast("bigint") if last else here - F.col(f"s{i + 1}")
        rows.append(
            F.struct(
                F.lit(label).alias("step"),
                here.alias("users_reached"),
                lost.alias("dropped_off"),
                (F.lit(0.0) if last else percent(lost, here)).alias("drop_off_pct"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


@any_names
def funnel_metrics(events: DataFrame, start, end, *, segment_by: str | None = None) -> DataFrame:
    """Sessions per step between two moments (both included), optionally per device or referrer.

    A session counts in every segment it has events in. Any other ``segment_by`` gives one row.
    """
    named = segment_by in FUNNEL_SEGMENTS
    segment = F.col(segment_by) if named else F.lit(None).cast("string")
    kind = events.schema["event_at"].dataType
    sessions = (
        events.filter(F.col("event_at").between(moment(start, kind), moment(end, kind)))
        .filter(F.col("session_id").isNotNull())
        .groupBy(segment.alias("segment"), "session_id")
        .agg(*_reached(FUNNEL_STEPS))
    )
    totals = _totals(sessions, FUNNEL_STEPS, "segment")
    n, cart, checkout, bought = F.col("sessions"), F.col("s2"), F.col("s3"), F.col("s4")
    return totals.select(
        "segment",
        n,
        cart.alias("add_to_cart"),
        checkout.alias("checkout_start"),
        bought.alias("purchases"),
        percent(cart, n).alias("pv_to_cart_pct"),
        percent(checkout, cart).alias("cart_to_checkout_pct"),
        percent(bought, n).alias("overall_conversion_pct"),
    )
