"""Frames, states and ranks per key against plain windows; one key holds a third of the rows."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import compare
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywork import operators as op
from tallywork.plans import ALL, Frame, keyed_frames, keyed_ranks
from tallywork.plans import frames as frames_module

START = datetime(2024, 1, 1)


def same(a, b):
    assert compare.spark_rows(a) == compare.spark_rows(b)


@pytest.fixture(scope="module")
def rows(spark):
    """Key 1 holds a third of the rows, some rows have no key, some no value; half of key 1 is one value."""
    pick = random.Random(5)
    made = []
    for i in range(900):
        key = 1 if i % 3 == 0 else pick.choice([None, *range(2, 40)])
        value = 7 if key == 1 and i % 2 else pick.choice([None, 3, 5, 7, 7, 11, 20])
        made.append((i, key, START + timedelta(hours=pick.randrange(300)), value, Decimal(pick.randrange(100))))
    return spark.createDataFrame(
        made, "id bigint, k int, at timestamp_ntz, v int, amount decimal(10,2)"
    )


LENGTHS = (1, 2, 7, 30, 64, 250, 5000)


@pytest.mark.parametrize("slices", [1, 8, 40, 300])
def test_frames_of_any_length(rows, many_slices, slices):
    order = Window.partitionBy("k").orderBy("at", "id")
    frames, plain = [], {}
    for kind, function in (("sum", F.sum), ("max", F.max), ("count", F.count), ("min", F.min)):
        for n in LENGTHS if kind != "min" else (30,):
            frames.append(Frame(f"{kind}_{n}", kind, "v", n))
            plain[f"{kind}_{n}"] = function("v").over(order.rowsBetween(1 - n, 0))
        frames.append(Frame(f"{kind}_so_far", kind, "v"))
        plain[f"{kind}_so_far"] = function("v").over(order.rowsBetween(Window.unboundedPreceding, 0))
        frames.append(Frame(f"{kind}_all", kind, "v", ALL))
        plain[f"{kind}_all"] = function("v").over(Window.partitionBy("k"))
    frames.append(Frame("money", "sum", "amount", 7))
    plain["money"] = F.sum("amount").over(order.rowsBetween(-6, 0))
    same(keyed_frames(rows, "k", ("at", "id"), frames, slices=slices), rows.withColumns(plain))


def test_a_long_frame_inside_a_block_gets_blocks_of_its_own(rows, many_slices, monkeypatch):
    monkeypatch.setattr(frames_module, "_SHORT", 5)
    order = Window.partitionBy("k").orderBy("at", "id")
    frames = [Frame(f"n{n}", "sum", "v", n) for n in (3, 6, 20, 40, 400)]
    plain = {f.out: F.sum("v").over(order.rowsBetween(1 - f.rows, 0)) for f in frames}
    same(keyed_frames(rows, "k", ("at", "id"), frames, slices=20), rows.withColumns(plain))


def test_no_task_holds_more_than_two_blocks(rows, many_slices, monkeypatch):
    seen = []
    plain = frames_module.join_null_safe

    def watched(left, right, columns, **how):
        if frames_module._BLOCK in columns:
            seen.append(left)
        return plain(left, right, columns, **how)

    monkeypatch.setattr(frames_module, "join_null_safe", watched)
    keyed_frames(rows, "k", ("at", "id"), [Frame("x", "sum", "v", 500)], slices=30)
    sizes = seen[0].groupBy("k", frames_module._BLOCK).count().collect()
    assert max(r["count"] for r in sizes) <= 900 / 30 and len(sizes) > 30


@pytest.mark.parametrize("slices", [1, 7, 60])
def test_ranks_with_peers(rows, many_slices, slices):
    by_value = Window.partitionBy("k").orderBy("v")
    plain = rows.withColumns(
        {
            "row_number": F.row_number().over(Window.partitionBy("k").orderBy("v", "id")),
            "rank": F.rank().over(by_value),
            "dense_rank": F.dense_rank().over(by_value),
            "total": F.count(F.lit(1)).over(Window.partitionBy("k")),
            "peers_sum": F.sum("amount").over(by_value),
            "peers_rows": F.count(F.lit(1)).over(by_value),
        }
    )
    same(keyed_ranks(rows, "k", "v", "id", measure="amount", slices=slices), plain)
    # a sum over peers without a value is NULL
    plain = rows.select("id", F.sum("v").over(by_value).alias("peers_sum"))
    found = keyed_ranks(rows, "k", "v", "id", measure="v", slices=slices)
    same(found.select("id", "peers_sum"), plain)


def test_empty_tables(rows):
    none = rows.filter("false")
    frames = [Frame("a", "sum", "v", 3), Frame("b", "max", "v"), Frame("c", "count", "v", ALL)]
    assert keyed_frames(none, "k", ("at", "id"), frames).collect() == []
    assert keyed_ranks(none, "k", "v", "id", measure="v").collect() == []


@pytest.fixture(scope="module")
def orders(spark):
    pick = random.Random(9)
    made = []
    for i in range(900):
        user = 1 if i % 3 == 0 else pick.randrange(2, 40)
        amount = Decimal(50) if user == 1 and i % 2 else Decimal(pick.choice([0, 10, 20, 35, 50]))
        made.append((i, user, START + timedelta(days=pick.randrange(90)), amount))
    return spark.createDataFrame(
        made, "order_id bigint, user_id bigint, order_date timestamp_ntz, net_revenue decimal(12,2)"
    )


@pytest.mark.parametrize("slices", [1, 50])
def test_moving_metrics(orders, many_slices, slices):
    found = op.user_moving_metrics(orders, lengths=(7, 100), slices=slices).collect()
    by_user = {}
    for r in sorted(orders.collect(), key=lambda r: (r.user_id, r.order_date, r.order_id)):
        by_user.setdefault(r.user_id, []).append(r)
    assert len(found) == 900
    places = {r.order_id: (rows, i) for rows in by_user.values() for i, r in enumerate(rows)}
    for r in found:
        rows, i = places[r.order_id]
        values = [x.net_revenue for x in rows]
        so_far, week, many = values[: i + 1], values[max(0, i - 6) : i + 1], values[max(0, i - 99) : i + 1]
        assert r.cumulative_revenue == sum(so_far)
        assert (r.max_7, r.max_100) == (max(week), max(many))
        for mean, frame in ((r.ma_7, week), (r.ma_100, many), (r.expanding_avg, so_far)):
            assert abs(mean - float(sum(frame)) / len(frame)) <= 0.0051
        share = 100 * float(values[i] / sum(values)) if sum(values) else None
        assert r.pct_of_user_revenue is share or abs(r.pct_of_user_revenue - share) <= 0.0051


@pytest.mark.parametrize("slices", [1, 50])
def test_event_fill(spark, many_slices, slices):
    pick = random.Random(3)
    made = []
    for i in range(600):
        user = 1 if i % 3 == 0 else pick.choice([None, *range(2, 20)])
        made.append((i, user, START + timedelta(minutes=pick.randrange(5000)), pick.choice(["page_view"] * 9 + ["purchase"])))
    events = spark.createDataFrame(made, "event_id bigint, user_id bigint, event_at timestamp_ntz, event_type string")
    order = Window.partitionBy("user_id").orderBy("event_at", "event_id")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bought = F.when(F.col("event_type") == "purchase", F.col("event_at"))
    plain = events.filter("user_id IS NOT NULL").select(
        "user_id",
        "event_id",
        "event_at",
        "event_type",
        F.lead("event_type").over(order).alias("next_event_type"),
        (F.timestamp_diff("MICROSECOND", "event_at", F.lead("event_at").over(order)) / 6e7).alias("m"),
        F.last(bought, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("last_goal_at"),
        F.first("event_type").over(whole).alias("first_event_type"),
        F.last("event_type").over(whole).alias("last_event_type"),
    )
    found = op.user_event_fill(events, slices=slices)
    same(found.drop("minutes_to_next"), plain.drop("m"))
    minutes = {r.event_id: r.m for r in plain.collect()}
    for r in found.collect():
        m = minutes[r.event_id]
        assert r.minutes_to_next is m or abs(r.minutes_to_next - m) <= 0.051


@pytest.mark.parametrize("slices", [1, 50])
def test_ranks_per_key(orders, many_slices, slices):
    most = Window.partitionBy("user_id").orderBy(F.col("net_revenue").desc())
    unique = Window.partitionBy("user_id").orderBy(F.col("net_revenue").desc(), "order_id")
    plain = orders.select(
        "user_id",
        "order_id",
        "net_revenue",
        F.row_number().over(unique).alias("rn_in_user"),
        F.rank().over(most).alias("rank_in_user"),
        F.dense_rank().over(most).alias("dense_rank_in_user"),
        F.ntile(4).over(unique).alias("bucket"),
        F.sum("net_revenue").over(most).alias("revenue_with_peers"),
        F.count(F.lit(1)).over(most).alias("orders_with_peers"),
    )
    same(op.ranks_per_user(orders, slices=slices), plain)
