"""Registered queries over the given parquet tables, and SQL that should give the same rows."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Mapping
from datetime import date, datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import DecimalType, IntegerType  # noqa: E402

import oracles  # noqa: E402
from tallywork import operators as op  # noqa: E402
from tallywork.fixed_values import COMPLETED, FUNNEL_STEPS  # noqa: E402
from tallywork.plans import adapt_to_skew, durable  # noqa: E402
from tallywork.plans.storage import new_folder  # noqa: E402
from tallywork.sources import (  # noqa: E402
    RULES,
    SCHEMAS,
    CheckedTable,
    KeyedTable,
    Snapshots,
    TradeTables,
    read_months,
    write_by_month,
)

try:
    import corpus_pipeline
    from tallywork.llm import entries as llm_entries
except ImportError as missing:  # the library also works without that subpackage or what it needs
    print(f"queries on training data are left out: {missing}", file=sys.stderr)
    corpus_pipeline = llm_entries = None

Tables = Mapping[str, DataFrame]

# parameters that the queries and their SQL share
PARAMETERS = oracles.PARAMETERS


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and ints as bigints, the types both engines report alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, IntegerType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _revenue(t: Tables) -> DataFrame:
    return op.order_revenue(t["placed_orders"], t["order_items"], t["products"])


def _now(t: Tables):
    return op.latest(t["placed_orders"], "order_date")


def _moment(name: str) -> datetime:
    return datetime.fromisoformat(PARAMETERS[name])


def _day(name: str) -> date:
    return date.fromisoformat(PARAMETERS[name])


def _top_n_per_user(t: Tables) -> DataFrame:
    rows = _revenue(t).select(
        "user_id", "order_id", F.to_date("order_date").alias("order_date"), "net_revenue"
    )
    order = [F.col("net_revenue").desc(), F.col("order_id").asc()]
    return op.top_n_per_group(rows, ["user_id"], order, 3, rank="revenue_rank")


def _nth_value(t: Tables) -> DataFrame:
    rows = _revenue(t).select("user_id", "order_id", "order_date", "net_revenue")
    order = ["order_date", "order_id"]
    return op.nth_per_group(rows, "user_id", order, 2, "net_revenue")


def _mrr(t: Tables, literal: bool) -> DataFrame:
    return op.mrr_movements(t["subscriptions"], literal=literal)


def _dup_audit(t: Tables) -> DataFrame:
    audit = op.duplicate_audit(t["events"])
    span = F.timestamp_diff("MICROSECOND", "first_seen", "last_seen") / 1e6
    return audit.withColumn("time_span", span)


def _has_events(t: Tables) -> DataFrame:
    return op.has_rows(t["events"], F.col("user_id") == PARAMETERS["event_user"])


def _plan_or_country(t: Tables) -> tuple:
    users = t["users"]
    return (
        users,
        users["country"] == PARAMETERS["country"],
        users["plan"] == PARAMETERS["plan"],
    )


def _events_month_pruned(t: Tables) -> DataFrame:
    events = t["events"]
    spark = events.sparkSession
    path = new_folder(spark, "events-by-month")
    write_by_month(events, path)
    lo, hi = _moment("month_from"), _moment("month_to")
    return read_months(spark, path, lo, hi, schema=events.schema)


def _orders_month_pruned(t: Tables) -> DataFrame:
    orders = t["placed_orders"]
    spark = orders.sparkSession
    path = new_folder(spark, "orders-by-month")
    write_by_month(orders, path, time="order_date", unique="order_id")
    lo, hi = _moment("order_month_from"), _moment("order_month_to")
    return read_months(spark, path, lo, hi, schema=orders.schema, time="order_date")


def _with_country(page: DataFrame, t: Tables) -> DataFrame:
    """Look up the shipping country for the rows of a page only."""
    countries = t["users"].select("user_id", F.col("country").alias("shipping_country"))
    return page.join(countries, "user_id", "left").select(
        "order_id", "user_id", "order_date", "status", "shipping_country"
    )


def _funnel_metrics(t: Tables, segment: str | None) -> DataFrame:
    start, end = _moment("funnel_from"), _moment("funnel_to")
    return op.funnel_metrics(t["events"], start, end, segment_by=segment)


def _cohort_api(t: Tables, wide: bool) -> DataFrame:
    start, end = _moment("cohort_from"), _moment("cohort_to")
    return op.cohort_retention_range(_revenue(t), start, end, max_period=6, wide=wide)


def _daily_summary_upsert(t: Tables) -> DataFrame:
    """A first load of all orders up to a day, then completed orders only from an earlier day on."""
    return _upserted(t, "unique_customers", "total_orders", "total_revenue", "gross_profit")


def _daily_summary_columns(t: Tables) -> DataFrame:
    """The same, but the second load brings two of the four columns."""
    return _upserted(t, "total_orders", "total_revenue")


def _upserted(t: Tables, *second_columns: str) -> DataFrame:
    booked = op.order_revenue(t["placed_orders"], t["order_items"], t["products"], status=None)
    spark = booked.sparkSession
    # a user's day once, for all orders and for completed ones; both loads come from it
    done = F.col("status") == COMPLETED
    sums = {"orders": F.lit(1), "revenue": F.col("net_revenue"), "profit": F.col("gross_profit")}
    days = durable(
        booked.groupBy(F.to_date("order_date").alias("period"), "user_id").agg(
            *(F.sum(c).alias(n) for n, c in sums.items()),
            *(F.sum(F.when(done, c)).alias(f"done_{n}") for n, c in sums.items()),
        ),
        "user-days",
    )

    def load(prefix: str) -> DataFrame:
        held = days.filter(F.col(f"{prefix}orders").isNotNull())
        return held.groupBy("period").agg(
            F.count("user_id").alias("unique_customers"),
            F.sum(f"{prefix}orders").alias("total_orders"),
            F.round(F.sum(f"{prefix}revenue"), 2).alias("total_revenue"),
            F.round(F.sum(f"{prefix}profit"), 2).alias("gross_profit"),
        )

    period = F.col("period")
    table = Snapshots(
        spark, new_folder(spark, "daily-summary"), part=lambda day: F.date_format(day, "yyyy")
    )
    table.upsert(load("").filter(period <= _day("first_load_to")))
    second = load("done_").filter(period >= _day("second_load_from"))
    table.upsert(second.select("period", *second_columns))
    return table.read()


def _user_totals_by_bucket(t: Tables) -> DataFrame:
    """Orders and plan of every user who placed some, from copies laid out by user."""
    spark = t["users"].sparkSession
    orders = KeyedTable(spark, new_folder(spark, "orders-by-user"), "user_id", buckets=8)
    users = KeyedTable(spark, new_folder(spark, "users-by-user"), "user_id", buckets=8)
    placed = t["placed_orders"]
    orders.write(placed.filter(F.col("order_id") % 4 != 0))
    orders.append(placed.filter(F.col("order_id") % 4 == 0))
    users.write(t["users"].select("user_id", "plan"))
    return orders.joined(users).groupBy("user_id", "plan").agg(
        F.count(F.lit(1)).alias("orders"), F.max("order_date").alias("last_order")
    )


def _append_checked(t: Tables) -> DataFrame:
    """Two loads of orders; the second brings known, repeated and broken rows. Rows by what they break."""
    orders, key = t["orders"], F.col("order_id")
    spark = orders.sparkSession
    table = CheckedTable(spark, new_folder(spark, "orders"), "orders", RULES, schema=SCHEMAS["orders"])
    table.append(orders.filter(key % 3 != 0), t)
    second = orders.filter((key % 3 == 0) | (key % 10 == 0)).withColumns(
        {
            "status": F.when(key % 7 == 0, "lost").otherwise(F.col("status")),
            "user_id": F.when(key % 13 == 0, F.col("user_id") + 10_000_000).otherwise(
                F.when(key % 11 != 0, F.col("user_id"))
            ),
        }
    )
    table.append(second.union(second.filter(key % 9 == 0)), t)
    ids = (F.count(F.lit(1)).alias("n"), F.sum("order_id").alias("order_ids"))
    broken = table.quarantine().select(F.array_join(F.array_sort("broken"), ", ").alias("broken"), "order_id")
    taken = table.read().select(F.lit("").alias("broken"), "order_id")
    return taken.union(broken).groupBy("broken").agg(*ids)


def _chunk_event_counts(t: Tables) -> DataFrame:
    def count_types(chunk):  # nested, so that workers get it by value
        counts = chunk.groupby("event_type").size()
        return counts.rename("n").reset_index()

    counts = op.process_in_chunks(
        t["events"].select("event_type"), count_types, "event_type string, n bigint"
    )
    return counts.groupBy("event_type").agg(F.sum("n").alias("n"))


def _org_tree(t: Tables) -> DataFrame:
    tree = op.traverse_hierarchy(t["employees"])
    return tree.withColumn("path", F.array_join(F.col("path").cast("array<string>"), "/"))


def _constraint_report(t: Tables) -> DataFrame:
    return op.check_constraints(t, RULES)


def _table_counts(t: Tables) -> DataFrame:
    names = ("users", "products", "order_items", "events", "subscriptions")
    return op.table_counts({"orders": t["placed_orders"], **{name: t[name] for name in names}})


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "order_revenue": _revenue,
    "rank_orders": lambda t: op.rank_orders(_revenue(t)),
    "top_n_per_user": _top_n_per_user,
    "mom_growth": lambda t: op.period_growth(_revenue(t)),
    "running_totals": lambda t: op.running_metrics(_revenue(t)),
    "first_last_value": lambda t: op.first_last_compare(_revenue(t)),
    "nth_value": _nth_value,
    "user_moving_metrics": lambda t: op.user_moving_metrics(_revenue(t)),
    "user_event_fill": lambda t: op.user_event_fill(t["events"]),
    "ranks_per_user": lambda t: op.ranks_per_user(_revenue(t)),
    "cohort_retention": lambda t: op.cohort_retention(_revenue(t)),
    "cohort_pivot": lambda t: op.cohort_retention_wide(_revenue(t)),
    "cohort_revenue": lambda t: op.cohort_revenue(_revenue(t)),
    "funnel_basic": lambda t: op.funnel(t["events"]),
    "funnel_five_steps": lambda t: op.funnel(t["events"], steps=(*FUNNEL_STEPS, "error")),
    "funnel_by_device": lambda t: op.funnel_by_segment(t["events"]),
    "time_to_convert": lambda t: op.time_to_convert(t["events"]),
    "funnel_dropoff": lambda t: op.funnel_dropoff(t["events"]),
    "mrr_movements": lambda t: _mrr(t, literal=False),
    "mrr_movements_literal": lambda t: _mrr(t, literal=True),
    "churn_nrr": lambda t: op.churn_nrr(t["subscriptions"]),
    "ltv_by_segment": lambda t: op.ltv_by_segment(t["users"], _revenue(t), as_of=_now(t)),
    "gap_fill": lambda t: op.gap_fill(t["placed_orders"], _revenue(t)),
    "gap_fill_literal": lambda t: op.gap_fill(t["placed_orders"], _revenue(t), literal=True),
    "mom_yoy": lambda t: op.period_over_period(_revenue(t)),
    "mom_yoy_dense": lambda t: op.period_over_period(_revenue(t), dense=True),
    "rolling_activity": lambda t: op.rolling_activity(_revenue(t)),
    "sessionize": lambda t: op.sessionize(t["events"]),
    "daily_spine": lambda t: op.date_spine_fill(_revenue(t), as_of=_now(t)),
    "org_tree": _org_tree,
    "lateral_top_n": lambda t: op.lateral_top_n(t["users"], _revenue(t)),
    "dedup_latest": lambda t: op.dedup_latest(t["events"]),
    "dup_audit": _dup_audit,
    "email_variants": lambda t: op.email_variants(t["users"]),
    "country_revenue": lambda t: op.country_revenue(t["users"], _revenue(t), as_of=_now(t)),
    "orders_per_user_corr": lambda t: op.orders_per_user_correlated(t["users"], t["placed_orders"]),
    "orders_per_user": lambda t: op.orders_per_user(t["users"], t["placed_orders"]),
    "orders_on_day": lambda t: op.rows_on_day(t["orders"], _day("order_day")),
    "union_or": lambda t: op.union_or(*_plan_or_country(t)),
    "or_filter": lambda t: op.matching_either(*_plan_or_country(t)),
    "has_events": _has_events,
    "keyset_page": lambda t: _with_country(
        op.keyset_page(t["placed_orders"], "order_id", PARAMETERS["page_after"]), t
    ),
    "offset_page": lambda t: _with_country(
        op.offset_page(t["placed_orders"], "order_id", PARAMETERS["page_offset"]), t
    ),
    "offset_page_far": lambda t: _with_country(
        op.offset_page(t["placed_orders"], "order_id", PARAMETERS["far_offset"]), t
    ),
    "events_month_pruned": _events_month_pruned,
    "orders_month_pruned": _orders_month_pruned,
    "cohort_api": lambda t: _cohort_api(t, wide=False),
    "cohort_api_wide": lambda t: _cohort_api(t, wide=True),
    "revenue_summary_day": lambda t: op.revenue_summary(_revenue(t), "day"),
    "revenue_summary_week": lambda t: op.revenue_summary(_revenue(t), "week"),
    "revenue_summary_month": lambda t: op.revenue_summary(_revenue(t), "month"),
    "revenue_summary_quarter": lambda t: op.revenue_summary(_revenue(t), "quarter"),
    "revenue_summary_year": lambda t: op.revenue_summary(_revenue(t), "year"),
    "revenue_rollups": lambda t: op.summaries_of_cells(durable(op.daily_cells(_revenue(t)), "cells")),
    "funnel_metrics": lambda t: _funnel_metrics(t, None),
    "funnel_metrics_device": lambda t: _funnel_metrics(t, "device_type"),
    "funnel_metrics_referrer": lambda t: _funnel_metrics(t, "referrer"),
    "daily_summary_upsert": _daily_summary_upsert,
    "daily_summary_columns": _daily_summary_columns,
    "append_checked": _append_checked,
    "user_totals_by_bucket": _user_totals_by_bucket,
    "chunk_event_counts": _chunk_event_counts,
    "table_counts": _table_counts,
    "constraint_report": _constraint_report,
}

ANALYTICS = tuple(_QUERIES)


def _prepare(spark: SparkSession) -> None:
    """Session settings that the queries rely on."""
    adapt_to_skew(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def entry(spark: SparkSession) -> DataFrame:
    """Cohort retention at the smallest scale."""
    return queries()["cohort_retention"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each takes (spark, folder of the tables)."""

    def run(build: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def query(spark: SparkSession, folder: str) -> DataFrame:
            _prepare(spark)
            return _plain(build(TradeTables(spark, folder)))

        return query

    found = {name: run(build) for name, build in _QUERIES.items()}
    if llm_entries:
        found |= llm_entries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """SQL over the registered tables for the keys of ``queries()`` that SQL can express."""
    found = oracles.sql()
    if llm_entries:
        found |= llm_entries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
