"""Tables stored in buckets of a key, so that work per key needs no shuffle."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.plans import durable, join_null_safe, remove

_HOT = "_hot"


class KeyedTable:
    """A copy of a table under ``path``, laid out by ``key``.

    Rows lie in ``buckets`` files by a hash of the key and sorted by it: a task reads a bucket, and
    joins and aggregates by key start from there. A key with more rows than a bucket has on average
    would make one task long; such keys, at most as many as buckets, lie in files of their own that
    are spread over all tasks, and their rows are summed before a small shuffle. Both parts together
    are the table.

    Appends add files; ``compact`` writes one file per bucket again and looks anew for large keys.
    The bucketed part is a table of the session's catalogue with a name of its own.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, *, buckets: int | None = None):
        self.spark, self.key, self._path = spark, key, path.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._name: str | None = None
        self._hot: DataFrame | None = None

    def write(self, df: DataFrame) -> "KeyedTable":
        """Lay out ``df`` as the whole table."""
        sizes = df.groupBy(self.key).agg(F.count(F.lit(1)).alias("_n"))
        # fewer keys than buckets can have more rows than a bucket has on average
        limit = sizes.agg((F.sum("_n") / self.buckets).alias("limit")).first()["limit"] or 0
        self._hot = durable(sizes.filter(F.col("_n") > F.lit(limit)).select(self.key), "large-keys")
        self._name = f"keyed_{uuid.uuid4().hex}"
        self._add(df, "errorifexists")
        return self

    def _parts(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = self._hot.withColumn(_HOT, F.lit(True))
        both = join_null_safe(df, F.broadcast(marked), [self.key], how="left")  # one row per bucket at most
        return both.filter(F.col(_HOT).isNull()).drop(_HOT), both.filter(_HOT).drop(_HOT)

    def _add(self, df: DataFrame, mode: str) -> None:
        cold, hot = self._parts(df)
        one_task_per_bucket = cold.repartition(self.buckets, self.key).sortWithinPartitions(self.key)
        writer = one_task_per_bucket.write.bucketBy(self.buckets, self.key).sortBy(self.key).mode(mode)
        writer.option("path", f"{self._path}/{self._name}/buckets").format("parquet").saveAsTable(self._name)
        hot.write.mode(mode).parquet(f"{self._path}/{self._name}/large")

    def append(self, df: DataFrame) -> None:
        """Add rows; columns as in the table."""
        self._add(df.select(*self.bucketed().columns), "append")

    def compact(self) -> None:
        """Write the table anew, with one file per bucket; files from before are deleted."""
        old, rows = self._name, self.rows()
        self.write(rows)
        self.spark.sql(f"DROP TABLE {old}")
        remove(self.spark, f"{self._path}/{old}")

    def bucketed(self) -> DataFrame:
        """The rows of all keys but the large ones."""
        return self.spark.table(self._name)

    def large(self) -> DataFrame:
        """The rows of the large keys."""
        return self.spark.read.schema(self.bucketed().schema).parquet(f"{self._path}/{self._name}/large")

    def rows(self) -> DataFrame:
        return self.bucketed().unionByName(self.large())

    def aggregate(self, *columns: Column) -> DataFrame:
        """Aggregates per key; the buckets need no shuffle, the large keys one of partial sums."""
        return self.bucketed().groupBy(self.key).agg(*columns).unionByName(self.large().groupBy(self.key).agg(*columns))

    def joined(self, other: "KeyedTable") -> DataFrame:
        """Inner join by key with a table that has a row per key and the same buckets.

        The buckets meet without a shuffle. Rows of large keys meet the few rows of ``other`` with
        these keys.
        """
        if other.buckets != self.buckets or other.key != self.key:
            raise ValueError("both tables need the same key and number of buckets")
        cold = self.bucketed().join(other.bucketed().hint("merge"), self.key)
        few = other.rows().join(F.broadcast(self._hot), self.key, "left_semi")  # a row per large key
        large = self.large().join(F.broadcast(few), self.key)
        # with a row per key the other table has large keys only if it has few rows
        rest = self.bucketed().join(F.broadcast(other.large()), self.key)
        return cold.unionByName(large).unionByName(rest)
