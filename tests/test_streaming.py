"""Streams over files against the batch operators."""

import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import compare
import pytest
from pyspark.sql import functions as F

from tallywork import operators as op
from tallywork.plans import durable
from tallywork.plans.storage import new_folder
from tallywork.streaming import CellTable, stream_cells, stream_sessions

START = datetime(2024, 1, 1)
EVENTS = "event_id bigint, user_id bigint, event_at timestamp, event_type string"


def _folders(spark, first, *others):
    """New paths; the first one exists."""
    path = new_folder(spark, first)
    os.makedirs(path.removeprefix("file:"))
    return path, *(new_folder(spark, name) for name in others)


def _run(spark, stream, checkpoint, rows):
    query = stream.writeStream.format("parquet").option("path", rows).option("checkpointLocation", checkpoint)
    query.outputMode("append").trigger(availableNow=True).start().awaitTermination(60)


def _sessions(df):
    return compare.spark_rows(
        df.select("user_id", "events_in_session", "session_start", "session_end", "duration_min", "converted")
    )


def test_sessions_of_a_stream_are_those_of_the_batch(spark):
    pick, clock, rows = random.Random(7), {}, []
    for i in range(600):
        user = 1 if i % 3 == 0 else pick.choice([None, *range(2, 30)])
        clock[user] = clock.get(user, START) + timedelta(minutes=pick.choice([0, 5, 29, 30, 31, 60]))
        rows.append((i, user, clock[user], pick.choice(["page_view", "purchase"])))
    rows.sort(key=lambda r: r[2])
    folder, checkpoint, found = _folders(spark, "events", "checkpoint", "sessions")
    events = spark.createDataFrame(rows, EVENTS)
    source = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(folder)
    for start in range(0, 600, 150):  # in order, but shuffled inside a file
        part = rows[start : start + 150]
        pick.shuffle(part)
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(folder)
        _run(spark, stream_sessions(source, late_minutes=30), checkpoint, found)
    before = spark.read.parquet(found).count()
    # an event far ahead closes all sessions; one that comes long after its time is left out
    ahead = [(9000, 99, START + timedelta(days=900), "page_view")]
    spark.createDataFrame(ahead, EVENTS).coalesce(1).write.mode("append").parquet(folder)
    _run(spark, stream_sessions(source, late_minutes=30), checkpoint, found)
    late = [(9001, 5, START, "purchase"), (9002, 99, START + timedelta(days=901), "page_view")]
    spark.createDataFrame(late, EVENTS).coalesce(1).write.mode("append").parquet(folder)
    _run(spark, stream_sessions(source, late_minutes=30), checkpoint, found)
    sent = spark.read.parquet(found)
    assert 0 < before < sent.count()
    assert _sessions(sent.filter("user_id <> 99")) == _sessions(op.sessionize(events))


def test_a_late_event_in_time_joins_two_sessions(spark):
    folder, checkpoint, found = _folders(spark, "events", "checkpoint", "sessions")
    source = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(folder)
    minutes = [[0, 50], [25], [5000], [5001]]
    for i, part in enumerate(minutes):
        events = [(i, 1, START + timedelta(minutes=m), "page_view") for m in part]
        spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(folder)
        _run(spark, stream_sessions(source, late_minutes=60), checkpoint, found)
    assert [r.events_in_session for r in spark.read.parquet(found).collect()] == [3]


@pytest.fixture(scope="module")
def orders(spark):
    pick, rows = random.Random(2), []
    for i in range(400):
        user = None if i % 40 == 0 else 1 if i % 3 == 0 else pick.choice([7, 40_000, pick.randrange(90_000)])
        when = START + timedelta(hours=pick.randrange(24 * 120))
        rows.append((i, user, when, Decimal(pick.randrange(500)), Decimal(pick.randrange(100))))
    schema = (
        "order_id bigint, user_id bigint, order_date timestamp, net_revenue decimal(12,2), "
        "gross_profit decimal(12,2)"
    )
    return spark.createDataFrame(rows, schema)


def test_rollups_are_the_summaries(spark, orders):
    cells = durable(op.daily_cells(orders), "cells")
    for name in ("day", "week", "month", "quarter", "year"):
        found = compare.spark_rows(op.summary_of_cells(cells, name))
        assert found == compare.spark_rows(op.revenue_summary(orders, name))
    plan = op.summaries_of_cells(cells)._jdf.queryExecution().executedPlan().toString()
    assert "cells-" in plan and "net_revenue" not in plan
    assert op.summary_of_cells(op.daily_cells(orders.filter("false"))).collect() == []


def test_a_batch_that_comes_again_changes_nothing(spark, orders):
    table = CellTable(spark, new_folder(spark, "cells"))
    assert table.cells().collect() == []
    parts = [orders.filter(F.col("order_id") % 3 == i) for i in range(3)]
    for number, part in enumerate(parts):
        assert table.add(part, "sales", number) > 0
    expected = compare.spark_rows(op.revenue_summary(orders, "week"))
    assert compare.spark_rows(table.summary("week")) == expected
    for number, part in enumerate(parts):
        assert table.add(part, "sales", number) == 0
    assert compare.spark_rows(table.summary("week")) == expected


def test_a_stream_into_the_summary_survives_a_lost_checkpoint(spark, orders):
    folder, first, second = (new_folder(spark, n) for n in ("orders", "checkpoint", "checkpoint"))
    table = CellTable(spark, new_folder(spark, "cells"))
    for i in range(3):
        orders.filter(F.col("order_id") % 3 == i).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    stream_cells(source, table, name="sales", checkpoint=first).awaitTermination(90)
    expected = compare.spark_rows(op.revenue_summary(orders, "day"))
    assert compare.spark_rows(table.summary()) == expected
    # the stream starts again from nothing and sends the same batches
    stream_cells(source, table, name="sales", checkpoint=second).awaitTermination(90)
    assert compare.spark_rows(table.summary()) == expected
    assert table._table._newest().batches == {"sales": 2}
