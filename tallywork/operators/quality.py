"""Duplicates, constraint checks and table counts."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions import any_names, normalise_email
from tallywork.operators.windows import top_n_per_group
from tallywork.plans import join_null_safe
from tallywork.sources.tables import Check, ForeignKey, Unique

EVENT_KEY = ("user_id", "session_id", "event_type")


def dedup_latest(
    df: DataFrame,
    *,
    keys: Sequence[str] = EVENT_KEY,
    time: str = "event_at",
    unique: str = "event_id",
) -> DataFrame:
    """The newest row per key; ``unique`` decides between equal times. NULL keys form a group."""
    newest_first = [F.col(time).desc_nulls_last(), F.col(unique).desc()]
    return top_n_per_group(df, keys, newest_first, 1, rank="_rank").drop("_rank")


def duplicate_audit(
    df: DataFrame, *, keys: Sequence[str] = EVENT_KEY, time: str = "event_at"
) -> DataFrame:
    """Keys that occur more than once, with their first and last time and the span between."""
    first, last = F.min(time), F.max(time)
    groups = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("duplicate_count"),
        first.alias("first_seen"),
        last.alias("last_seen"),
        (last - first).alias("time_span"),
    )
    return groups.filter(F.col("duplicate_count") > 1)


@any_names
def email_variants(users: DataFrame) -> DataFrame:
    """Each user's normalised email and how many users share it.

    The counts are summed before the shuffle and joined back; Spark splits the partition of an
    address that a large share of the users normalise to, so it is never gathered.
    """
    rows = users.select(
        "user_id", "email", normalise_email(F.col("email")).alias("normalised_email")
    )
    counts = rows.groupBy("normalised_email").agg(F.count(F.lit(1)).alias("variants_count"))
    joined = join_null_safe(rows, counts, ["normalised_email"])
    return joined.select("user_id", "email", "normalised_email", "variants_count")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.lit(name).alias("tbl"), F.count(F.lit(1)).alias("n"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def check_constraints(
    tables: Mapping[str, DataFrame], rules: Sequence[Check | Unique | ForeignKey]
) -> DataFrame:
    """Rows that break each rule: (table_name, rule, violations).

    The checks of a table are counted in one pass without a shuffle. Unique columns, and both sides of a
    foreign key, are grouped by value, so that repeated values are counted before the shuffle and values
    meet once; a column that several rules name is grouped once. Nothing is stored. A key held n times
    counts n - 1 violations; NULLs break no unique or foreign key.
    """
    held: dict[tuple[str, str], DataFrame] = {}

    def values(table: str, column: str) -> DataFrame:
        if (table, column) not in held:
            known = tables[table].select(F.col(column).alias("_value")).filter("_value IS NOT NULL")
            held[table, column] = known.groupBy("_value").agg(F.count(F.lit(1)).alias("_n"))
        return held[table, column]

    found = []
    for table, df in tables.items():
        checks = [r for r in rules if isinstance(r, Check) and r.table == table]
        if checks:
            found.append(_broken_checks(df, checks))
    for rule in rules:
        if isinstance(rule, Unique):
            repeats = values(rule.table, rule.column).agg(F.sum(F.col("_n") - 1).alias("n"))
            found.append(_violations(rule, repeats))
        elif isinstance(rule, ForeignKey):
            orphans = values(rule.table, rule.column).join(
                values(rule.parent, rule.key).select("_value"), "_value", "left_anti"
            )
            found.append(_violations(rule, orphans.agg(F.sum("_n").alias("n"))))
    return reduce(DataFrame.unionByName, found)


def _violations(rule: Unique | ForeignKey, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.name).alias("rule"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("violations"),
    )


def _broken_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """A row per check of a table; a condition that is NULL holds, as in a SQL CHECK."""
    broken = [F.count(F.when(~F.expr(r.condition), F.lit(1))).alias(f"n{i}") for i, r in enumerate(checks)]
    listed = [
        F.struct(
            F.lit(r.table).alias("table_name"), F.lit(r.name).alias("rule"), F.col(f"n{i}").alias("violations")
        )
        for i, r in enumerate(checks)
    ]
    return df.agg(*broken).select(F.inline(F.array(*listed)))
