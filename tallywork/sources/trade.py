"""The logical tables derived from a trade schema (customer, orders, lineitem, part, events)."""

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.sources.tables import SCHEMAS


def _pick(number: Column, *values: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number + 1).cast("int"))


def _by_name(column: Column, names: dict[str, object], rest) -> Column:
    chosen = F
    for name, value in names.items():
        chosen = chosen.when(column == name, F.lit(value))
    return chosen.otherwise(F.lit(rest))


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


# columns that the logical tables use; a declared schema also saves a job per table
_FILES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_discount double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
}


class TradeTables(Mapping):
    """The logical tables by name, each built when it is first asked for.

    ``orders`` looks up the shipping country of every order; ``placed_orders`` is the same table
    without that column and without the join.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._built: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(_FILES[name]).parquet(f"{self._folder}/{name}.parquet")

    def _customers(self) -> DataFrame:
        customer, nation = self._read("customer"), self._read("nation")
        return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")

    def _build(self, name: str) -> DataFrame:
        match name:
            case "users":
                return _users(self._customers())
            case "products":
                return _products(self._read("part"))
            case "orders":
                return _orders(self["placed_orders"], self._customers())
            case "placed_orders":
                return _placed_orders(self._read("orders"))
            case "order_items":
                return _items(self._read("lineitem"), self["products"])
            case "events":
                return _events(self._read("events"))
            case "subscriptions":
                return _subscriptions(self._read("orders"))
            case "employees":
                return _employees(self._read("customer"))
        raise KeyError(name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)


def _users(customers: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    group = key % 4
    number = ((key - group) / 4).cast("bigint").cast("string")
    email = (
        F.when(group == 0, F.concat(F.lit("user"), number, F.lit("@example.com")))
        .when(group == 1, F.concat(F.lit("User"), number, F.lit("+promo@Example.com")))
        .when(group == 2, F.concat(F.lit("user"), number, F.lit("+b@example.com")))
        .otherwise(F.concat(F.lit("solo"), number, F.lit("@example.com")))
    )
    created = F.lit("1999-01-01").cast("timestamp_ntz") + _days(key * 37 % 900)
    plans = {
        "BUILDING": "free",
        "FURNITURE": "free",
        "AUTOMOBILE": "starter",
        "MACHINERY": "pro",
        "HOUSEHOLD": "enterprise",
    }
    return customers.select(
        key.alias("user_id"),
        email.alias("email"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("country"),
        _by_name(F.col("c_mktsegment"), plans, None).alias("plan"),
        _pick(group, "organic", "paid", "referral", "direct").alias("acquired_channel"),
        created.alias("created_at"),
        F.when(key % 5 == 0, created + F.expr("interval 100 days")).alias("churned_at"),
    )


def _products(part: DataFrame) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(10,2)")
    launched = F.date_add(F.lit("2022-01-01").cast("date"), (F.col("p_partkey") % 800).cast("int"))
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        price.alias("price"),
        (price * F.expr("CAST(0.60 AS DECIMAL(3,2))")).alias("cost"),
        launched.alias("launched_at"),
    )


def _placed_orders(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus").isin("F", "O"), "completed")
        .when(key % 2 == 0, "refunded")
        .otherwise("cancelled")
    )
    return orders.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
        status.alias("status"),
    )


def _orders(placed: DataFrame, customers: DataFrame) -> DataFrame:
    countries = customers.select(
        F.col("c_custkey").alias("user_id"), F.col("n_name").alias("shipping_country")
    )
    joined = placed.join(countries, "user_id", "left")
    return joined.select("order_id", "user_id", "order_date", "status", "shipping_country")


def _items(lineitem: DataFrame, products: DataFrame) -> DataFrame:
    prices = products.select("product_id", F.col("price").alias("unit_price"))
    items = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_pct"),
    )
    return items.join(prices, "product_id", "left").select(
        "order_id", "product_id", "quantity", "unit_price", "discount_pct"
    )


def _events(events: DataFrame) -> DataFrame:
    key = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    kinds = {"view": "page_view", "click": "add_to_cart", "signup": "checkout_start"}
    kind = F.col("event_type")
    mapped = F
    for name, value in kinds.items():
        mapped = mapped.when(kind == name, value)
    day = F.date_format("ts", "yyyyMMdd")
    session = F.concat(F.lit("sess_"), F.col("user_id").cast("string"), F.lit("_"), day)
    return events.select(
        key.alias("event_id"),
        F.when(key % 5 != 0, F.col("user_id")).alias("user_id"),
        session.alias("session_id"),
        mapped.otherwise(kind).alias("event_type"),
        (key % 200).alias("product_id"),
        F.col("ts").alias("event_at"),
        _pick(k % 4, "mobile", "mobile", "desktop", "tablet").alias("device_type"),
        _pick(k % 5, "google", "direct", "facebook", "email", "referral").alias("referrer"),
    )


def _subscriptions(orders: DataFrame) -> DataFrame:
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    plans = {"1-URGENT": "enterprise", "2-HIGH": "pro"}
    prices = {"1-URGENT": 4999, "2-HIGH": 1999, "3-MEDIUM": 499, "4-NOT SPECIFIED": 499}
    started = F.to_date("o_orderdate")
    ended = F.when(
        F.col("o_orderstatus") == "F", F.date_add(started, (key % 60 - 5).cast("int"))
    )
    return orders.select(
        key.alias("sub_id"),
        F.col("o_custkey").alias("user_id"),
        _by_name(priority, plans, "starter").alias("plan"),
        _by_name(priority, prices, 0).cast("decimal(10,2)").alias("mrr"),
        started.alias("started_at"),
        ended.alias("ended_at"),
        F.when(ended.isNotNull() & (key % 4 == 0), "too_expensive").alias("churn_reason"),
    )


def _employees(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    manager = F.when(key != 0, F.floor((key - 1) / 10) + 1)
    return customer.select(
        (key + 1).alias("emp_id"), F.col("c_name").alias("name"), manager.alias("manager_id")
    )
