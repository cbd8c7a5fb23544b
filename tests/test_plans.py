"""Physical plans keep the properties that matter at scale."""

import re
from datetime import date

import __spark_entry__ as entry_module
from conftest import SF_DIR
from pyspark.sql import functions as F

from tallywork import operators as op


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return plan_of(df).count("Exchange hashpartitioning")


def test_top_n_is_limited_before_the_shuffle(revenue):
    order = [F.col("net_revenue").desc(), F.col("order_id").asc()]
    plan = plan_of(op.top_n_per_group(revenue, ["user_id"], order, 3))
    assert plan.count("WindowGroupLimit") == 2  # per task, then per group
    assert "Partial" in plan


def test_dedup_is_limited_before_the_shuffle(tables):
    assert plan_of(op.dedup_latest(tables["events"])).count("WindowGroupLimit") == 2


def test_day_range_reaches_the_scan(tables):
    plan = plan_of(op.rows_on_day(tables["placed_orders"], date(1998, 10, 3)))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_scan_reads_only_the_columns_in_use(tables):
    plan = plan_of(op.funnel(tables["events"]))
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert "props" not in schema and "event_id" not in schema


def test_pages_take_the_top_rows(tables):
    orders = tables["placed_orders"]
    plan = plan_of(op.keyset_page(orders, "order_id", 1000))
    assert "TakeOrderedAndProject" in plan and "GreaterThan(o_orderkey,1000)" in plan

def test_registered_pages_look_up_the_rows_of_the_page_only(spark):
    for name in ("keyset_page", "offset_page", "offset_page_far"):
        plan = plan_of(entry_module.queries()[name](spark, SF_DIR))
        lookup = plan[plan.index("Join") :]  # the first join is the lookup of the country
        before = lookup[: lookup.index("c_custkey")]
        assert "LeftOuter" in lookup.splitlines()[0] and "TakeOrderedAndProject(limit=" in before
        assert plan.count("orders.parquet") == 1


def test_existence_reads_the_table_and_stops_early(spark):
    plan = plan_of(entry_module.queries()["has_events"](spark, SF_DIR))
    assert "events.parquet" in plan and "LocalLimit 1" in plan


def test_cohort_window_reaches_the_scan(spark):
    for name in ("cohort_api", "cohort_api_wide"):
        plan = plan_of(entry_module.queries()[name](spark, SF_DIR))
        scan = next(x for x in plan.splitlines() if "Filter" in x and "o_orderdate" in x)
        assert re.search(r"o_orderdate#\d+ >= 1996-01-01", scan)
        assert re.search(r"o_orderdate#\d+ < 1999-01-01", scan)
        assert "cast(o_orderdate" not in scan


def test_month_folders_are_pruned(spark):
    found = entry_module.queries()["orders_month_pruned"](spark, SF_DIR)
    read = found.select(F.input_file_name()).distinct().collect()
    assert {r[0].split("event_month=")[1][:7] for r in read} == {"1997-02", "1997-03", "1997-04"}


def test_constraint_report_groups_keys_by_their_own_type(spark):
    report = entry_module.queries()["constraint_report"](spark, SF_DIR)
    report.collect()
    plan = plan_of(report).split("Initial Plan")[0]
    assert "ReusedExchange" in plan  # orders.order_id is unique and a parent's key
    assert not re.search(r"as string\) AS _value", plan)
    assert "Exchange hashpartitioning(_value" in plan and plan.count("partial_count") > 10


def test_either_is_one_scan(tables):
    users = tables["users"]
    plan = plan_of(op.union_or(users, users["country"] == "X", users["plan"] == "pro"))
    assert plan.count("c_custkey") and plan.count("customer.parquet") == 1


def test_funnel_shuffles_once_by_session(tables):
    assert exchanges(op.funnel(tables["events"])) == 1


def test_cohorts_need_no_join(revenue):
    plan = plan_of(op.cohort_retention(revenue))
    assert "Join" not in plan
    assert "partial_" in plan or "keys=[user_id" in plan


def test_correlated_count_becomes_a_join(tables):
    plan = plan_of(op.orders_per_user_correlated(tables["users"], tables["placed_orders"]))
    assert "LeftOuter" in plan


def test_global_windows_see_aggregates_only(revenue):
    """A window without keys sits above an aggregate, never above raw rows."""
    for df in (op.running_metrics(revenue), op.rolling_activity(revenue), op.period_over_period(revenue)):
        lines = plan_of(df).splitlines()
        single = next(i for i, line in enumerate(lines) if "Exchange SinglePartition" in line)
        assert "Aggregate" in "".join(lines[single + 1 : single + 4])


def test_order_join_follows_the_partial_sums(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = tables
        df = op.order_revenue(t["placed_orders"], t["order_items"], t["products"])
        # lineitem, two lookups of part, the sums and the orders: nothing is shuffled twice
        assert exchanges(df) <= 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ranks_shuffle_the_rows_once_more_than_the_sort(revenue):
    plan = plan_of(op.rank_orders(revenue))
    assert plan.count("shufflepartitionidpassthrough") == 2  # the rows, and their values for the borders
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
