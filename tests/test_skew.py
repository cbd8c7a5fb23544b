"""The paths for hot keys and large groups give the rows of the plain ones."""

import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import compare
from tallywork import operators as op
from tallywork.plans import (
    adapt_to_skew,
    exact_percentiles,
    global_ranks,
    order_rows,
    row_numbers,
    rows_by_rank,
)
from tallywork.plans.ordered import SLICE
from tallywork.plans.storage import application_folder

START = datetime(2024, 1, 1)


def same(a, b):
    assert compare.spark_rows(a) == compare.spark_rows(b)


@pytest.fixture(scope="module")
def skewed_events(spark):
    """User 1 holds a third of the events; gaps of 5 to 60 minutes, some equal times."""
    pick = random.Random(7)
    clock = {}
    rows = []
    for i in range(1500):
        user = 1 if i % 3 == 0 else pick.randrange(2, 60)
        step = pick.choice([0, 5, 29, 30, 31, 60])
        clock[user] = clock.get(user, START) + timedelta(minutes=step)
        rows.append((i, user, clock[user], pick.choice(["page_view", "purchase"])))
    return spark.createDataFrame(
        rows, "event_id bigint, user_id bigint, event_at timestamp_ntz, event_type string"
    )


@pytest.fixture(scope="module")
def skewed_subscriptions(spark):
    pick = random.Random(8)
    rows = []
    for i in range(1200):
        user = 1 if i % 3 == 0 else pick.randrange(2, 50)
        start = (START + timedelta(days=pick.randrange(400))).date()
        mrr = Decimal(pick.choice([0, 499, 1999]))
        end = start + timedelta(days=pick.randrange(-3, 50)) if pick.random() < 0.3 else None
        rows.append((i, user, mrr, start, end))
    return spark.createDataFrame(
        rows, "sub_id bigint, user_id bigint, mrr decimal(10,2), started_at date, ended_at date"
    )


@pytest.fixture(scope="module")
def skewed_revenue(spark):
    pick = random.Random(9)
    rows = []
    for i in range(1500):
        user = 1 if i % 3 == 0 else pick.randrange(2, 40)
        when = START + timedelta(days=pick.randrange(90))
        rows.append((i, user, when, Decimal(pick.choice([0, 10, 20, 35, 50]))))
    return spark.createDataFrame(
        rows, "order_id bigint, user_id bigint, order_date timestamp_ntz, net_revenue decimal(12,2)"
    )


@pytest.mark.parametrize("slices", [6, 30, 300])
def test_keys_are_cut_into_even_slices(skewed_events, slices):
    ordered = order_rows(skewed_events, "user_id", ("event_at", "event_id"), slices=slices)
    sizes = ordered.df.groupBy("user_id", SLICE).count().collect()
    n = skewed_events.count()
    assert max(r["count"] for r in sizes) < 2.5 * n / slices + 40  # the sample has 20 rows a slice
    first = [r for r in sizes if r["user_id"] == 1]
    assert len(first) >= slices / 3 * 0.6


@pytest.mark.parametrize(("guess", "passes"), [(1500, 1), (200, 1), (10**12, 3)])
def test_one_pass_finds_the_borders(skewed_events, monkeypatch, guess, passes):
    """Counts how often the input is computed, for a right, a low and a far too high guess of its size."""
    from tallywork.plans import ordered

    read = skewed_events.sparkSession.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = skewed_events.mapInArrow(counted, skewed_events.schema)
    monkeypatch.setattr(ordered, "_guessed_rows", lambda rows: guess)
    borders = dict(ordered._borders(source, "user_id", ("event_at", "event_id"), 30))
    assert read.value == passes * 1500
    assert len(borders[1]) >= 5


def test_a_small_share_is_cut_at_a_small_slice_size(spark):
    """One key with 0.04 % of the rows and slices of half of that."""
    key = F.when(F.col("id") < 40, 0).otherwise(F.col("id"))
    rows = spark.range(100_000).select(key.alias("k"), F.col("id").alias("t"))
    cut = order_rows(rows, "k", ("t",), slices=5000).df
    sizes = cut.filter("k = 0").groupBy(SLICE).count().collect()
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 40


def test_slices_follow_the_order_and_do_not_change(skewed_events, many_slices):
    cut = order_rows(skewed_events, "user_id", ("event_at", "event_id"), slices=40).df
    one, two = ({r["event_id"]: r[SLICE] for r in df.collect()} for df in (cut, cut.repartition(3)))
    assert one == two
    rows = cut.filter("user_id = 1").orderBy("event_at", "event_id").collect()
    numbers = [r[SLICE] for r in rows]
    assert numbers == sorted(numbers) and numbers[-1] > 5


@pytest.mark.parametrize("slices", [1, 9, 200])
def test_sessionize(skewed_events, many_slices, slices):
    order = Window.partitionBy("user_id").orderBy("event_at", "event_id")
    gap = F.col("event_at") > F.lag("event_at").over(order) + F.expr("interval 30 minutes")
    starts = skewed_events.withColumn("s", F.coalesce(gap, F.lit(True)).cast("int"))
    plain = starts.withColumn("session_num", F.sum("s").over(order))
    plain = plain.groupBy("user_id", "session_num").agg(F.count(F.lit(1)).alias("n"))
    found = op.sessionize(skewed_events, slices=slices)
    same(found.select("user_id", "session_num", F.col("events_in_session").alias("n")), plain)


@pytest.mark.parametrize("literal", [False, True])
def test_mrr_movements(skewed_subscriptions, many_slices, literal):
    whole, cut = (
        op.mrr_movements(skewed_subscriptions, literal=literal, slices=n) for n in (1, 100)
    )
    same(cut, whole)


def test_churn_nrr(skewed_subscriptions, many_slices):
    whole, cut = (op.churn_nrr(skewed_subscriptions, slices=n) for n in (1, 100))
    same(cut, whole)


@pytest.mark.parametrize("slices", [1, 7, 40])
def test_previous_and_sums_against_plain_windows(frame, many_slices, slices):
    rows = [(key, i, None if i % 4 == 0 else i) for key in (1, None) for i in range(40)]
    df = frame(rows, "k int, t int, v int")
    window = Window.partitionBy("k").orderBy("t")
    plain = df.select(
        "k", "t", "v",
        F.lag("v").over(window).alias("p"),
        F.sum("t").over(window).alias("total"),
        F.row_number().over(window).cast("bigint").alias("n"),
    )
    ordered = order_rows(df, "k", ("t",), slices=slices)
    found = ordered.with_previous("v", "p").with_running_sum("t", "total").with_row_number("n")
    same(found.rows(), plain)


@pytest.mark.parametrize("slices", [1, 100])
def test_first_last_compare(skewed_revenue, many_slices, slices):
    window = Window.partitionBy("user_id").orderBy("order_date", "order_id")
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    plain = skewed_revenue.select(
        "order_id",
        F.first("net_revenue").over(whole).alias("first_order_revenue"),
        F.last("net_revenue").over(whole).alias("latest_order_revenue"),
        F.row_number().over(window).cast("bigint").alias("order_number"),
    )
    found = op.first_last_compare(skewed_revenue, slices=slices)
    same(found.select(*plain.columns), plain)


@pytest.mark.parametrize("n", [1, 3, 400, 5000])
def test_nth_per_group(skewed_revenue, many_slices, n):
    order = ["order_date", "order_id"]
    whole = Window.partitionBy("user_id").orderBy(*order)
    whole = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    plain = skewed_revenue.withColumn("nth_value", F.nth_value("net_revenue", n).over(whole))
    same(op.nth_per_group(skewed_revenue, "user_id", order, n, "net_revenue"), plain)


def test_email_variants(frame):
    rows = [(i, f"Box+{i}@Mail.com" if i % 3 == 0 else f"u{i % 40}@mail.com") for i in range(300)]
    users = frame([*rows, (300, None), (301, None)], "user_id bigint, email string")
    counts = {r["user_id"]: r["variants_count"] for r in op.email_variants(users).collect()}
    assert counts[0] == 100 and counts[300] == 2 and len(counts) == 302


def test_top_n_beyond_the_group_limit(skewed_revenue, many_slices, monkeypatch):
    order = [F.col("net_revenue").desc(), F.col("order_id").asc()]
    plain = op.top_n_per_group(skewed_revenue, ["user_id"], order, 5)
    monkeypatch.setattr("tallywork.operators.windows.GROUP_LIMIT", 2)
    same(op.top_n_per_group(skewed_revenue, ["user_id"], order, 5), plain)


@pytest.mark.parametrize("slices", [1, 4, 16, 60])
def test_global_ranks(skewed_revenue, slices):
    rows = skewed_revenue.withColumn("month", F.trunc(F.to_date("order_date"), "month"))
    by_value = Window.orderBy(F.col("net_revenue").desc())
    unique = Window.orderBy(F.col("net_revenue").desc(), "order_id")
    in_month = Window.partitionBy("month").orderBy(F.col("net_revenue").desc(), "order_id")
    plain = (
        rows.withColumn("row_number", F.row_number().over(unique))
        .withColumn("rank", F.rank().over(by_value))
        .withColumn("dense_rank", F.dense_rank().over(by_value))
        .withColumn("row_number_within", F.row_number().over(in_month))
        .withColumn("total", F.count(F.lit(1)).over(Window.partitionBy()))
    )
    same(global_ranks(rows, "net_revenue", "order_id", within="month", slices=slices), plain)


def test_rank_orders_buckets(skewed_revenue, many_slices):
    for buckets in (7, 100, 4000):
        order = Window.orderBy(F.col("net_revenue").desc(), "order_id")
        plain = skewed_revenue.select("order_id", F.ntile(buckets).over(order).alias("b"))
        ranked = op.rank_orders(skewed_revenue, buckets=buckets)
        same(ranked.select("order_id", F.col("percentile_bucket").alias("b")), plain)


def test_row_numbers(frame, many_slices):
    pick = random.Random(3)
    rows = [(pick.choice([None, "a", "b"]), pick.randrange(20), i) for i in range(500)]
    df = frame(rows, "k string, v int, id int")
    window = Window.partitionBy("k").orderBy("v", "id")
    plain = df.withColumn("n", F.row_number().over(window))
    same(row_numbers(df, ["k"], [F.col("v").asc(), F.col("id").asc()], "n"), plain)


@pytest.mark.parametrize(("bins", "listed"), [(1024, 10_000), (4, 3), (2, 1), (7, 60)])
@pytest.mark.parametrize("kind", ["int", "decimal(34,6)"])
def test_exact_percentiles(frame, many_slices, bins, listed, kind):
    pick = random.Random(4)
    rows = [("a" if i % 3 else pick.choice([None, "b"]), pick.choice([7, pick.randrange(500)])) for i in range(601)]
    rows += [("single", 3), ("none", None), ("same", 5), ("same", 5), ("wide", 1), ("wide", 10**9), ("wide", 10**9 + 1)]
    df = frame(rows, "k string, v int").withColumn("v", F.col("v").cast(kind))
    shares = {"p0": 0.0, "p37": 0.37, "p50": 0.5, "p100": 1.0}
    found = exact_percentiles(df, ["k"], "v", shares, also={"n": F.count(F.lit(1))}, bins=bins, listed=listed)
    plain = df.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), *(F.percentile("v", p).alias(name) for name, p in shares.items())
    )
    got = {r["k"]: r for r in found.collect()}
    for row in plain.collect():
        assert got[row["k"]]["n"] == row["n"]
        for name in shares:
            if row[name] is None:
                assert got[row["k"]][name] is None
            else:
                assert got[row["k"]][name] == pytest.approx(row[name])
    assert len(got) == plain.count()
    whole = exact_percentiles(df, [], "v", {"p50": 0.5}, bins=bins, listed=listed).first()
    assert whole.p50 == pytest.approx(df.agg(F.percentile("v", 0.5)).first()[0])
    assert exact_percentiles(df.filter("false"), ["k"], "v", shares).collect() == []


@pytest.mark.parametrize("most", [1, 40, 1_000_000])
def test_pages_by_rank(frame, many_slices, most):
    pick = random.Random(6)
    rows = [(None if i % 50 == 0 else pick.randrange(200), pick.choice(["x", None, "y"])) for i in range(700)]
    rows += [(77, "same")] * 90
    df = frame(rows, "k int, t string")
    plain = [tuple(r) for r in df.orderBy(F.col("k").asc_nulls_first(), F.col("t").asc_nulls_first()).collect()]
    for offset, size in ((0, 5), (3, 20), (300, 20), (330, 100), (785, 20), (790, 5), (5000, 3), (0, 2000)):
        page = rows_by_rank(df, ["k", "t"], offset, size, slices=9, most=most)
        assert [tuple(r) for r in page.collect()] == plain[offset : offset + size]


def test_pages_and_percentiles_write_no_file(spark, tables):
    def written():
        place = application_folder(spark).replace("file:", "")
        return {f for _, _, files in os.walk(place) for f in files}

    before = written()
    page = op.offset_page(tables["placed_orders"], "order_id", 10_000)
    assert page.count() == 20
    assert "PushedFilters: [" in (plan := page._jdf.queryExecution().executedPlan().toString())
    assert "GreaterThanOrEqual(o_orderkey" in plan and "LessThanOrEqual(o_orderkey" in plan
    assert op.time_to_convert(tables["events"]).count() == 1
    assert written() == before


@pytest.fixture
def split_small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def skewed_orders(spark):
    """A third of the items are of product 7."""
    product = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    items = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("order_id"), product.alias("product_id"), F.lit(1).alias("quantity")
    )
    discount = F.lit(0).cast("decimal(5,2)").alias("discount_pct")
    orders = spark.range(60_000).select(
        F.col("id").alias("order_id"),
        F.lit(1).alias("user_id"),
        F.lit(START).alias("order_date"),
        F.lit("completed").alias("status"),
    )
    lookup = spark.range(500).select(F.col("id").alias("product_id"))
    return items.withColumn("discount_pct", discount), orders, lookup


def test_frequent_product_is_split(spark, split_small_partitions):
    adapt_to_skew(spark)
    items, orders, lookup = skewed_orders(spark)
    two = F.lit(2).cast("decimal(10,2)")
    products = lookup.withColumn("cost", F.lit(1).cast("decimal(10,2)"))
    # once with the price in the items, once with a lookup of the price before that of the cost
    own_price = items.withColumn("unit_price", two)
    looked_up = items.join(lookup.withColumn("unit_price", two), "product_id")
    for priced, splits in ((own_price, 1), (looked_up, 2)):
        result = op.order_revenue(orders, priced, products)
        assert result.select(F.sum("gross_profit")).first()[0] == 60_000
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
        final = plan.split("Initial Plan")[0]
        assert final.count("skew=true") == splits
