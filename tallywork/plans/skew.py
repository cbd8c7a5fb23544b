"""Session settings that let Spark split skewed joins."""

from pyspark.sql import SparkSession


def adapt_to_skew(spark: SparkSession) -> None:
    """Let Spark split skewed join partitions at run time, also where that costs a shuffle.

    Meant for the set-up of a session; operators do not change settings.
    """
    for name in ("enabled", "skewJoin.enabled", "forceOptimizeSkewedJoin"):
        spark.conf.set(f"spark.sql.adaptive.{name}", "true")
