"""Order revenue, revenue by period and lifetime value."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.fixed_values import ACTIVE_DAYS, COMPLETED
from tallywork.functions import any_names, average, half_up, month_of, percent, period_of, ratio
from tallywork.plans import durable, exact_percentiles


def latest(df: DataFrame, time: str) -> Column:
    """The newest ``time`` in ``df`` as a scalar subquery: the default "now" of the operators."""
    return df.agg(F.max(time)).scalar()


@any_names
def order_revenue(
    orders: DataFrame, items: DataFrame, products: DataFrame, *, status: str | None = COMPLETED
) -> DataFrame:
    """Net revenue, cost and profit per order; all statuses when ``status`` is None.

    Items are summed per order before they meet the orders, so the partial sums absorb an order
    with very many items and the join is one row to one row. The lookup of the cost is left to
    Spark: it broadcasts products below its size threshold, and above it splits the partition of
    a frequent product at run time (see ``adapt_to_skew``).
    """
    # exact: the hundredth of the percentage is taken once per order
    hundredfold = F.col("quantity") * F.col("unit_price") * (F.lit(100) - F.col("discount_pct"))
    net = F.sum(hundredfold).cast("decimal(34,4)") * F.lit(Decimal("0.01"))
    per_order = (
        items.join(products.select("product_id", "cost"), "product_id")
        .groupBy("order_id")
        .agg(
            net.alias("net_revenue"),
            F.sum(F.col("quantity") * F.col("cost")).alias("total_cost"),
        )
    )
    wanted = orders if status is None else orders.filter(F.col("status") == status)
    return (
        wanted.select("order_id", "user_id", "order_date", "status")
        .join(per_order, "order_id")
        .withColumn("gross_profit", F.col("net_revenue") - F.col("total_cost"))
    )


@any_names
def revenue_summary(revenue: DataFrame, granularity: str = "month") -> DataFrame:
    """Customers, orders, revenue and margin per period, with growth on the previous row."""
    period = period_of(F.col("order_date"), granularity)
    per_customer = revenue.groupBy(period.alias("period"), "user_id").agg(
        F.count("order_id").alias("orders"),
        F.sum("net_revenue").alias("revenue"),
        F.sum("gross_profit").alias("profit"),
    )
    per_period = per_customer.groupBy("period").agg(
        F.count("user_id").alias("unique_customers"),
        F.sum("orders").alias("total_orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"),
    )
    return summarised(per_period)


def summarised(per_period: DataFrame) -> DataFrame:
    """The columns of a revenue summary from the totals of each period."""
    rounded = F.round("revenue", 2)
    previous = F.lag("total_revenue").over(Window.orderBy("period"))  # one row per period
    return per_period.select(
        "period",
        "unique_customers",
        "total_orders",
        rounded.alias("total_revenue"),
        average(F.col("revenue"), F.col("total_orders"), 2).alias("avg_order_value"),
        F.round("profit", 2).alias("gross_profit"),
        percent(F.col("profit"), F.col("revenue")).alias("gross_margin_pct"),
    ).withColumn("revenue_mom_pct", (ratio(F.col("total_revenue"), previous) - 1) * 100)


@any_names
def ltv_by_segment(
    users: DataFrame, revenue: DataFrame, *, as_of: Column, active_days: int = ACTIVE_DAYS
) -> DataFrame:
    """Average customer value and a lifetime-value estimate per plan and channel.

    A customer is inactive when the last order is ``active_days`` or more before ``as_of``.
    """
    per_month = revenue.groupBy("user_id", month_of(F.col("order_date")).alias("month")).agg(
        F.sum("net_revenue").alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.max("order_date").alias("last_order"),
    )
    per_user = per_month.groupBy("user_id").agg(
        F.sum("revenue").cast("decimal(34,6)").alias("total_revenue"),
        F.sum("orders").alias("orders"),
        F.count(F.lit(1)).alias("active_months"),
        F.max("last_order").alias("last_order"),
    )
    active = F.col("last_order") > as_of - F.make_dt_interval(F.lit(active_days))
    customers = users.select("user_id", "plan", "acquired_channel").join(per_user, "user_id")
    customers = customers.select(
        "plan",
        "acquired_channel",
        "total_revenue",
        "active_months",
        _exact(ratio(F.col("total_revenue"), F.col("orders"))).alias("order_value"),
        _exact(ratio(F.col("total_revenue"), F.col("active_months"))).alias("monthly"),
        (~active).cast("int").alias("inactive"),
    )
    segment = ["plan", "acquired_channel"]
    # one narrow row per customer, so that orders and items are joined once
    totals = exact_percentiles(
        durable(customers, "customers"),
        segment,
        "total_revenue",
        {"p90": 0.9},
        also={
            "customer_count": F.count(F.lit(1)),
            "revenue": F.sum("total_revenue"),
            "order_values": F.sum("order_value"),
            "months": F.sum("active_months"),
            "monthly": F.sum("monthly"),
            "inactive": F.sum("inactive"),
        },
    )
    n = F.col("customer_count")
    monthly_mean = ratio(F.col("monthly"), n)
    top_share = F.lit(100.0) * ratio(F.col("p90"), F.col("revenue")) * n.cast("double") * 0.1
    return totals.select(
        *segment,
        n,
        average(F.col("revenue"), n, 2).alias("avg_total_revenue"),
        average(F.col("order_values"), n, 2).alias("avg_order_value"),
        average(F.col("months"), n, 1).alias("avg_active_months"),
        half_up(monthly_mean, 2).alias("avg_monthly_revenue"),
        half_up(ratio(monthly_mean, ratio(F.col("inactive"), n)), 2).alias("estimated_ltv"),
        half_up(top_share, 1).alias("top10pct_revenue_share_pct"),
    )


def _exact(quotient: Column) -> Column:
    """Fix a quotient to 6 decimals so that its sum does not depend on the order of addition."""
    return half_up(quotient, 6).cast("decimal(28,6)")
