"""One object that holds the logical tables and offers the most used reports."""

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

import pandas as pd
from pyspark import Accumulator
from pyspark.sql import DataFrame, SparkSession

from tallywork import operators
from tallywork.fixed_values import CHUNK_SIZE
from tallywork.plans import durable
from tallywork.sources import Snapshots, by_month


class Analytics:
    """Reports over the logical tables; every method returns a DataFrame."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame]):
        self.spark, self.tables = spark, dict(tables)
        self._revenue: DataFrame | None = None

    @property
    def revenue(self) -> DataFrame:
        """Revenue per completed order."""
        if self._revenue is None:
            t = self.tables
            self._revenue = operators.order_revenue(t["orders"], t["order_items"], t["products"])
        return self._revenue

    def pin_revenue(self) -> None:
        """Store the order revenue in the shared folder, for a run of several reports."""
        self._revenue = durable(self.revenue, "revenue")

    def cohort_retention(
        self, start_date="2023-01-01", end_date=None, max_period: int = 12
    ) -> DataFrame:
        return operators.cohort_retention_range(self.revenue, start_date, end_date, max_period=max_period)

    def revenue_summary(self, granularity: str = "month") -> DataFrame:
        return operators.revenue_summary(self.revenue, granularity)

    def funnel_metrics(self, start_date, end_date, segment_by: str | None = None) -> DataFrame:
        return operators.funnel_metrics(self.tables["events"], start_date, end_date, segment_by=segment_by)

    def upsert_daily_summary(self, rows: DataFrame, path: str) -> int:
        """Merge daily summary rows into the table at ``path``; returns the rows that came in.

        The table has a part per month, so a load of recent days rewrites few of them.
        """
        return Snapshots(self.spark, path, "period", part=by_month).upsert(rows)

    def process_in_chunks(
        self,
        query: str,
        fn: Callable[[pd.DataFrame], pd.DataFrame | None],
        schema: str,
        *,
        chunk_size: int = CHUNK_SIZE,
        params: Mapping | None = None,
        counter: Accumulator | None = None,
    ) -> DataFrame:
        """Run ``fn`` on chunks of a query's result; the query may name its parameters.

        The query sees the object's tables by their names.
        """
        with self._named_tables():
            rows = self.spark.sql(query, args=dict(params or {}))
        return operators.process_in_chunks(
            rows, fn, schema, chunk_size=chunk_size, counter=counter
        )

    @contextmanager
    def _named_tables(self) -> Iterator[None]:
        """The tables as temporary views, while a query is resolved; hidden views come back."""
        catalog = self.spark.catalog
        own = {t.name for t in catalog.listTables() if t.isTemporary}
        hidden = {name: self.spark.table(name) for name in own & set(self.tables)}
        try:
            for name, df in self.tables.items():
                df.createOrReplaceTempView(name)
            yield
        finally:
            for name in self.tables:
                catalog.dropTempView(name)
            for name, df in hidden.items():
                df.createOrReplaceTempView(name)
