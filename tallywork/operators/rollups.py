"""Daily totals that add up to longer periods, distinct customers included.

Users are bits: a cell holds the totals of a day for 32,768 neighbouring user ids, and which of them
placed orders. Bitmaps of days merge into bitmaps of weeks, months, quarters and years, so that exact
distinct counts of any period come from the cells, without reading the orders again.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.fixed_values import GRANULARITIES
from tallywork.functions import any_names, day_of, period_of
from tallywork.operators.revenue import summarised

CELL = ("day", "bucket")


@any_names
def daily_cells(revenue: DataFrame) -> DataFrame:
    """One row per day and block of user ids: ``users`` (a bitmap), ``orders``, ``revenue``, ``profit``.

    User ids are whole numbers from 0 on; orders without a user have cells of their own and count no
    user. A bitmap takes 4 KB, so a cell is smaller than its orders unless they are few.
    """
    user = F.col("user_id")
    known = F.when(user >= 0, user)
    return revenue.groupBy(
        day_of(F.col("order_date")).alias("day"), F.bitmap_bucket_number(known).alias("bucket")
    ).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(known)).alias("users"),
        F.count("order_id").alias("orders"),
        F.sum("net_revenue").cast("decimal(38,6)").alias("revenue"),
        F.sum("gross_profit").cast("decimal(38,6)").alias("profit"),
    )


def merged_cells(cells: DataFrame, *keys: str) -> DataFrame:
    """Cells put together by some keys: bitmaps are united, totals added."""
    return cells.groupBy(*keys).agg(
        F.bitmap_or_agg("users").alias("users"),
        F.sum("orders").alias("orders"),
        F.sum("revenue").cast("decimal(38,6)").alias("revenue"),
        F.sum("profit").cast("decimal(38,6)").alias("profit"),
    )


def summary_of_cells(cells: DataFrame, granularity: str = "month") -> DataFrame:
    """``revenue_summary`` from cells instead of orders."""
    period = period_of(F.col("day"), granularity).alias("period")
    per_block = merged_cells(cells.select(period, "bucket", "users", "orders", "revenue", "profit"), "period", "bucket")
    per_period = per_block.groupBy("period").agg(
        F.sum(F.bitmap_count("users")).alias("unique_customers"),
        F.sum("orders").alias("total_orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"),
    )
    return summarised(per_period)


def summaries_of_cells(cells: DataFrame) -> DataFrame:
    """The summaries of all granularities, with their name in ``granularity``; read ``cells`` stored."""
    parts = [
        summary_of_cells(cells, name).select(F.lit(name).alias("granularity"), "*") for name in GRANULARITIES
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
