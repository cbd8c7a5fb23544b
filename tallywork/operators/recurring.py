"""Recurring revenue: movements, churn and retention."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.fixed_values import CHURN, CONTRACTION, EXPANSION, NEW, REACTIVATION, UNCHANGED
from tallywork.functions import any_names, half_up, month_of, percent, ratio
from tallywork.plans import order_rows


def _movement(literal: bool) -> Column:
    """The class of a change from ``prev_mrr`` to ``mrr``.

    ``literal`` tests for growth before reactivation, which leaves reactivation empty.
    """
    now, before = F.col("mrr"), F.col("prev_mrr")
    tests = [
        (before.isNull() & (now > 0), NEW),
        ((before == 0) & (now > 0), REACTIVATION),
        (now > before, EXPANSION),
        ((now < before) & (now > 0), CONTRACTION),
        ((before > 0) & (now == 0), CHURN),
    ]
    if literal:
        tests.append(tests.pop(1))
    kind = F
    for test, label in tests:
        kind = kind.when(test, label)
    return kind.otherwise(UNCHANGED)


@any_names
def mrr_movements(
    subscriptions: DataFrame, *, literal: bool = False, slices: int | None = None
) -> DataFrame:
    """New, expansion, reactivation, contraction and churn revenue per month.

    Each subscription record is compared with the user's previous one. A sum is NULL in a month
    without such a movement. ``slices``: see ``order_rows``.
    """
    rows = subscriptions.select("user_id", "sub_id", "started_at", "mrr")
    compared = order_rows(rows, "user_id", ("started_at", "sub_id"), slices=slices)
    compared = compared.with_previous("mrr", "prev_mrr").rows()
    before = F.coalesce(F.col("prev_mrr"), F.lit(0))
    changes = compared.filter(F.col("mrr") != before).select(
        month_of(F.col("started_at")).alias("month"),
        _movement(literal).alias("kind"),
        (F.col("mrr") - before).alias("delta"),
    )

    def amount(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("delta")))

    def count(kind: str) -> Column:
        return F.count(F.when(F.col("kind") == kind, F.lit(1)))

    monthly = changes.groupBy("month").agg(
        amount(NEW).alias("new_mrr"),
        amount(EXPANSION).alias("expansion_mrr"),
        amount(REACTIVATION).alias("reactivation_mrr"),
        amount(CONTRACTION).alias("contraction_mrr"),
        amount(CHURN).alias("churn_mrr"),
        F.sum("delta").alias("net_new_mrr"),
        count(NEW).alias("new_customers"),
        count(CHURN).alias("churned_customers"),
        count(EXPANSION).alias("expanded_customers"),
    )
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ending = F.sum("net_new_mrr").over(so_far)
    return monthly.select(
        "month",
        "new_mrr",
        "expansion_mrr",
        "reactivation_mrr",
        "contraction_mrr",
        "churn_mrr",
        "net_new_mrr",
        ending.alias("ending_mrr"),
        "new_customers",
        "churned_customers",
        "expanded_customers",
    )


@any_names
def churn_nrr(subscriptions: DataFrame, *, slices: int | None = None) -> DataFrame:
    """Beginning, ending, churned and expansion revenue per month with churn and retention rates.

    "Beginning" is the user's previous record. Records that ended on or before their start are
    left out. ``quick_ratio`` is (ending - beginning + churned) / churned.
    """
    rows = subscriptions.filter(
        F.col("ended_at").isNull() | (F.col("ended_at") > F.col("started_at"))
    ).select("user_id", "sub_id", month_of(F.col("started_at")).alias("month"), "mrr")
    compared = order_rows(rows, "user_id", ("month", "sub_id"), slices=slices)
    compared = compared.with_previous("mrr", "prev_mrr").rows()
    now, before, none = F.col("mrr"), F.col("prev_mrr"), F.lit(0)
    churned = F.when((now == 0) & (before > 0), before).otherwise(none)
    grown = F.when((now > before) & (before > 0), now - before).otherwise(none)
    monthly = compared.groupBy("month").agg(
        F.sum(F.coalesce(before, none)).alias("beginning_mrr"),
        F.sum(now).alias("ending_mrr"),
        F.sum(churned).alias("churned_mrr"),
        F.sum(grown).alias("expansion_mrr"),
    )
    start, end = F.col("beginning_mrr"), F.col("ending_mrr")
    lost, gained = F.col("churned_mrr"), F.col("expansion_mrr")
    return monthly.select(
        "month",
        start,
        end,
        lost,
        gained,
        percent(lost, start, 2).alias("gross_churn_rate_pct"),
        percent(start + gained - lost, start).alias("nrr_pct"),
        half_up(ratio(end - start + lost, lost), 2).alias("quick_ratio"),
    )
