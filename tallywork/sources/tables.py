"""The logical tables: columns, types and the rules their rows should keep."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywork.fixed_values import ORDER_STATUSES, PLANS

SCHEMAS = {
    "users": "user_id bigint, email string, name string, country string, plan string, "
    "acquired_channel string, created_at timestamp, churned_at timestamp",
    "products": "product_id bigint, name string, category string, subcategory string, "
    "price decimal(10,2), cost decimal(10,2), launched_at date",
    "orders": "order_id bigint, user_id bigint, order_date timestamp, status string, "
    "shipping_country string",
    "order_items": "item_id bigint, order_id bigint, product_id bigint, quantity int, "
    "unit_price decimal(10,2), discount_pct decimal(5,2)",
    "events": "event_id bigint, user_id bigint, session_id string, event_type string, "
    "product_id bigint, event_at timestamp, device_type string, referrer string",
    "subscriptions": "sub_id bigint, user_id bigint, plan string, mrr decimal(10,2), "
    "started_at date, ended_at date, churn_reason string",
    "employees": "emp_id bigint, name string, manager_id bigint",
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the columns of a logical table."""
    fields = StructType.fromDDL(SCHEMAS[table]).fields
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields))


def read_tables(spark: SparkSession, folder: str, *, format: str = "parquet") -> dict[str, DataFrame]:
    """The logical tables stored under ``folder``, one sub-folder each."""
    return {
        name: conform(spark.read.format(format).load(f"{folder}/{name}"), name) for name in SCHEMAS
    }


@dataclass(frozen=True)
class Check:
    """A condition every row of a table meets, or leaves NULL."""

    table: str
    name: str
    condition: str


@dataclass(frozen=True)
class Unique:
    table: str
    column: str

    @property
    def name(self) -> str:
        return f"{self.column} unique"


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str
    key: str

    @property
    def name(self) -> str:
        return f"{self.column} in {self.parent}"


def _not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, f"{c} not null", f"{c} IS NOT NULL") for c in columns]


def _one_of(table: str, column: str, values: tuple[str, ...]) -> Check:
    listed = ", ".join(f"'{v}'" for v in values)
    return Check(table, f"{column} allowed", f"{column} IN ({listed})")


RULES = (
    *_not_null("users", "user_id", "email", "name", "country", "plan", "created_at"),
    _one_of("users", "plan", PLANS),
    Unique("users", "user_id"),
    Unique("users", "email"),
    *_not_null("products", "product_id", "name", "category", "price", "cost", "launched_at"),
    Check("products", "price positive", "price > 0"),
    Check("products", "cost positive", "cost > 0"),
    Unique("products", "product_id"),
    *_not_null("orders", "order_id", "user_id", "order_date", "status", "shipping_country"),
    _one_of("orders", "status", ORDER_STATUSES),
    Unique("orders", "order_id"),
    ForeignKey("orders", "user_id", "users", "user_id"),
    *_not_null("order_items", "order_id", "product_id", "quantity", "unit_price", "discount_pct"),
    Check("order_items", "quantity positive", "quantity > 0"),
    Check("order_items", "discount_pct range", "discount_pct BETWEEN 0 AND 100"),
    ForeignKey("order_items", "order_id", "orders", "order_id"),
    ForeignKey("order_items", "product_id", "products", "product_id"),
    *_not_null("events", "event_id", "session_id", "event_type", "event_at"),
    Unique("events", "event_id"),
    ForeignKey("events", "user_id", "users", "user_id"),
    ForeignKey("events", "product_id", "products", "product_id"),
    *_not_null("subscriptions", "sub_id", "user_id", "plan", "mrr", "started_at"),
    Check("subscriptions", "mrr not negative", "mrr >= 0"),
    Unique("subscriptions", "sub_id"),
    ForeignKey("subscriptions", "user_id", "users", "user_id"),
    *_not_null("employees", "emp_id", "name"),
    Unique("employees", "emp_id"),
    ForeignKey("employees", "manager_id", "employees", "emp_id"),
)
# a key of order_items for tables that carry one
ITEM_RULES = (*_not_null("order_items", "item_id"), Unique("order_items", "item_id"))
