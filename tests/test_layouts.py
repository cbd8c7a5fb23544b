"""Tables laid out by key."""

import os

import compare
import pytest
from pyspark.sql import functions as F

from tallywork.plans.storage import new_folder
from tallywork.sources import KeyedTable


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def orders(spark):
    """Key 7 holds a third of the rows; some rows have no key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.col("id") % 97)
    return spark.range(3000).select(key.alias("k"), F.col("id").alias("order_id"))


@pytest.fixture
def keyed(spark, orders):
    table = KeyedTable(spark, new_folder(spark, "keyed"), "k", buckets=8)
    return table.write(orders)


def test_buckets_hold_no_large_key(keyed, orders):
    assert {r.k for r in keyed.large().distinct().select("k").collect()} == {7}
    assert compare.spark_rows(keyed.rows()) == compare.spark_rows(orders)


def test_aggregates_need_no_shuffle(keyed, orders):
    totals = (F.count(F.lit(1)).alias("n"), F.max("order_id").alias("last"))
    found = keyed.aggregate(*totals)
    assert compare.spark_rows(found) == compare.spark_rows(orders.groupBy("k").agg(*totals))
    assert "Exchange" not in plan_of(keyed.bucketed().groupBy("k").agg(*totals))


def test_joins_need_no_shuffle(spark, keyed, orders, no_broadcast):
    names = spark.range(97).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    orders = orders.withColumn("k", F.col("k").cast("int"))
    left = KeyedTable(spark, new_folder(spark, "keyed"), "k", buckets=8).write(orders)
    right = KeyedTable(spark, new_folder(spark, "keyed"), "k", buckets=8).write(names)
    assert compare.spark_rows(left.joined(right)) == compare.spark_rows(orders.join(names, "k"))
    met = left.bucketed().join(right.bucketed().hint("merge"), "k")
    assert "SortMergeJoin" in plan_of(met) and "Exchange" not in plan_of(met)
    small = KeyedTable(spark, new_folder(spark, "keyed"), "k", buckets=8).write(names.filter("k in (1, 7)"))
    expected = orders.join(names.filter("k in (1, 7)"), "k")
    assert compare.spark_rows(left.joined(small)) == compare.spark_rows(expected)
    with pytest.raises(ValueError, match="buckets"):
        left.joined(KeyedTable(spark, new_folder(spark, "keyed"), "k", buckets=4).write(names))


def _files(table):
    folder = f"{table._path}/{table._name}/buckets".removeprefix("file:")
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


def test_appends_and_compaction(keyed, orders):
    more = orders.withColumn("order_id", F.col("order_id") + 10_000)
    for _ in range(3):
        keyed.append(more)
    keyed.append(more.select("order_id", F.lit(5).alias("k")))  # a key that becomes large
    expected = orders
    for _ in range(3):
        expected = expected.union(more)
    expected = expected.union(more.select(F.lit(5).alias("k"), "order_id"))
    assert compare.spark_rows(keyed.rows()) == compare.spark_rows(expected)
    assert len(_files(keyed)) > 8
    keyed.compact()
    assert len(_files(keyed)) <= 8
    assert compare.spark_rows(keyed.rows()) == compare.spark_rows(expected)
    assert {r.k for r in keyed.large().distinct().select("k").collect()} == {5, 7}


def test_empty(spark, orders):
    table = KeyedTable(spark, new_folder(spark, "keyed"), "k", buckets=8).write(orders.filter("false"))
    assert table.rows().collect() == [] and table.aggregate(F.count(F.lit(1)).alias("n")).collect() == []
